"""Operators against their SQL, on whole small tables; and the SQL against the operators on awkward rows."""

import random

import duckdb
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from claimweave.llm import embedding_dedup, jaccard_join, oracle, queries, substring_dedup

TABLES = {"op1_ngram_jaccard": "documents", "op2_embedding_dedup": "embeddings", "op4_substring_dedup": "documents", "op13_conversation_repair": "conversations"}
SPACED = "a\tb\n c\x0bd\x0ce  f\rg h "


@pytest.fixture(scope="module", autouse=True)
def importable(spark):
    queries.reachable(spark)


def in_sql(sql, name, relation):
    duck = duckdb.connect()
    if isinstance(relation, str):
        duck.execute(f"create view {name} as select * from '{relation}'")
    else:
        duck.register(name, relation)
    cursor = duck.execute(sql)
    names = [d[0] for d in cursor.description]
    return sorted((tuple(r[names.index(c)] for c in sorted(names)) for r in cursor.fetchall()), key=repr), sorted(names)


def rows(df, columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


@pytest.mark.parametrize("query", TABLES)
def test_query_equals_its_sql(spark, sf_dir, query):
    name = TABLES[query]
    expected, names = in_sql(queries.oracle_sql()[query], name, f"{sf_dir}/{name}.parquet")
    found = queries.queries()[query](spark, sf_dir)
    assert sorted(found.columns) == names
    assert rows(found, names) == expected


def texts():
    long = [f"w{i}" for i in range(70)]
    made = [None, "", " \t\n", "one two", "ONE  two", SPACED, SPACED.upper(), "the " * 400, "x" * 30_000, "é 中文 😀 " * 9]
    made += [" ".join(long), " ".join(long), " ".join([*long, "tail"]), " ".join(long[30:] + long[:30])]
    # A chain: neighbours are alike, its ends are not.
    made += [" ".join(f"c{i}" for i in range(5 * k, 100 + 5 * k)) for k in range(6)]
    return {"doc_id": list(range(1, len(made) + 1)), "text": made}


@pytest.mark.parametrize(
    ("sql", "operator"),
    [(oracle.NGRAM_JACCARD, jaccard_join.ngram_jaccard_join), (oracle.SUBSTRING_DEDUP, substring_dedup.substring_dedup)],
)
def test_text_sql_on_awkward_rows(spark, sql, operator):
    made = texts()
    expected, names = in_sql(sql, "documents", pa.table(made))
    df = spark.createDataFrame(list(zip(*made.values(), strict=True)), "doc_id long, text string").repartition(5)
    assert rows(operator(df), names) == expected
    assert in_sql(sql, "documents", pa.table(made).slice(0, 0))[0] == []


def test_vector_sql_on_awkward_rows(spark):
    nan, inf = float("nan"), float("inf")
    vectors = [[1.0, 0.0], [2.0, 0.0], [1.0, 0.25], [1.0, 0.75], [0.0, 0.0], [nan, 1.0], [inf, 1.0], [None, 1.0], None, [], [1.0, 0.0, 0.0], [-1.0, 0.0], [1.0, 0.0], [1.0, 0.5]]
    labels = [1] * 12 + [None, 1]
    made = pa.table({"vec_id": list(range(len(vectors))), "embedding": pa.array(vectors, pa.list_(pa.float32())), "label": labels})
    expected, names = in_sql(oracle.EMBEDDING_DEDUP, "embeddings", made)
    df = spark.createDataFrame(list(zip(range(len(vectors)), vectors, labels, strict=True)), "vec_id long, embedding array<float>, label int")
    assert rows(embedding_dedup.embedding_dedup(df), names) == expected


def test_conversation_sql_on_awkward_rows(spark, tmp_path):
    rng = random.Random(13)
    roles = ["user", "assistant", "system", "tool", "u", "", None]
    texts = ["Yes.", "Yes. ", "No", "", " \t", "é!", "a\nb?\n", "Why? no", None, "x" * 9000]
    made = []
    for conv in [*range(60), None]:
        for turn in range(rng.randrange(1, 14)):
            number = rng.choice([turn, turn, turn, turn + 3, None])
            role = rng.choice(["user", "assistant"][turn % 2 :][:1] * 8 + roles)
            made.append((conv, number, role, rng.choice(["Yes.", f"Right {turn}.", f"Well {turn}!"] * 6 + texts)))
    columns = dict(zip(("conv_id", "turn", "role", "text"), zip(*made, strict=True), strict=True))
    kinds = {"conv_id": pa.int64(), "turn": pa.int64(), "role": pa.string(), "text": pa.string()}
    table = pa.table({c: pa.array(v, kinds[c]) for c, v in columns.items()})
    pq.write_table(table, tmp_path / "conversations.parquet")
    expected, names = in_sql(oracle.CONVERSATION_REPAIR, "conversations", table)
    assert rows(queries.op13_conversation_repair(spark, str(tmp_path)), names) == expected
    # Never I: instead of an inserted turn and its partner, the partner is deleted for less.
    assert {letter for row in expected for letter in row[0]} == set("KRD")
    assert in_sql(oracle.CONVERSATION_REPAIR, "conversations", table.slice(0, 0))[0] == []
