"""Every operator against a plain-Python reading of its contract, on whole small tables and on awkward rows."""

import base64
import hashlib
import random
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import public_tokenizers as P
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from claimweave.llm import (
    byte_bpe,
    decontaminate,
    embedding_dedup,
    hashing,
    html_extract,
    jaccard_join,
    language_id,
    pii,
    quality,
    queries,
    substring_dedup,
    token_records,
)
from . import brute

LONG = " ".join(f"w{i}" for i in range(60))
AWKWARD = [
    (1, LONG, "en"),
    (2, LONG + " tail", "en"),
    (3, LONG, None),
    (3, LONG, None),
    (4, None, "en"),
    (5, "", "de"),
    (6, " \t\n", "de"),
    (7, "one two", "en"),
    (8, "ONE two", "en"),
    (9, "the " * 400, "en"),
    (10, "mail a.b@c.example.org call +1 (234) 555-1234 at 10.0.0.1 or 4111 1111 1111 1111 x@y", "en"),
    (11, "x" * 30_000 + "@" + "é 中文 😀 <|endoftext|> " * 50, "fr"),
    (12, " ".join(f"w{i}" for i in range(30, 90)), "en"),
]


@pytest.fixture(scope="module", autouse=True)
def importable(spark):
    queries.reachable(spark)


@pytest.fixture(scope="module")
def awkward(spark):
    rows = [(*r, "clash", 0, b"k", "r") for r in AWKWARD]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, id string, n_words int, key binary, _row string")


@pytest.fixture(scope="module")
def docs(sf_dir):
    table = pq.read_table(f"{sf_dir}/documents.parquet", columns=["doc_id", "text"]).to_pydict()
    return list(zip(table["doc_id"], table["text"], strict=True))


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def distinct(pairs):
    return sorted(set(pairs), key=repr)


UNIQUE = [r[:2] for r in AWKWARD if r[0] != 3] + [(3, LONG)]


def test_jaccard(spark, sf_dir, docs, awkward):
    columns = ["doc_id", "n_shingles", "component_id"]
    assert rows(queries.op1_ngram_jaccard(spark, sf_dir), *columns) == sorted(brute.jaccard(docs), key=repr)
    found = rows(jaccard_join.ngram_jaccard_join(awkward), *columns)
    assert distinct(found) == sorted(brute.jaccard(UNIQUE), key=repr) and len(found) == len(AWKWARD)
    assert jaccard_join.ngram_jaccard_join(awkward.limit(0)).count() == 0


def test_jaccard_of_many_near_copies(spark):
    base = [f"t{i}" for i in range(120)]
    made = [(k, " ".join(base[:p] + [f"x{k}"] + base[p + 1 :])) for k, p in enumerate(np.random.default_rng(1).integers(0, 120, 80).tolist())]
    made += [(100 + k, " ".join([f"y{k}{j}" for j in range(12 + k % 5)] + base[12 + k % 5 :])) for k in range(40)]
    df = spark.createDataFrame(made, "doc_id long, text string")
    assert rows(jaccard_join.ngram_jaccard_join(df), "doc_id", "n_shingles", "component_id") == sorted(brute.jaccard(made), key=repr)


def test_pairs_of_a_group_of_near_copies(spark, monkeypatch):
    """Chains of ever more distant copies, which the first meetings leave apart, come together before all their pairs are asked for."""
    rng = np.random.default_rng(5)
    base = [f"t{i}" for i in range(150)]
    made = []
    for k in range(400):
        words = list(base)
        for p in rng.choice(150, 4 + k % 5, replace=False).tolist():
            words[p] = f"x{k}"
        made.append((k, " ".join(words)))
    asked, pairs = [], jaccard_join._tile_pairs
    monkeypatch.setattr(jaccard_join, "_tile_pairs", lambda *a: (asked.append(pairs(*a)), asked[-1])[1])
    df = spark.createDataFrame(made, "doc_id long, text string")
    assert rows(jaccard_join.ngram_jaccard_join(df), "doc_id", "n_shingles", "component_id") == sorted(brute.jaccard(made), key=repr)
    assert sum(p.count() for p in asked) < 4 * len(made)


def test_earlier_rows_of_a_tile():
    """All at once they are judged as pair by pair, over several widths of bitmaps."""
    rng = np.random.default_rng(6)
    pool = rng.integers(1, 2**63, 400).astype(np.uint64)
    sets = sorted((np.unique(rng.choice(pool, rng.integers(20, 300))) for _ in range(120)), key=len)
    earlier, before = jaccard_join._Earlier(), []
    for k, grams in enumerate(sets):
        bits = jaccard_join._bitmap(grams)
        others, shares = earlier.possible(len(grams), k % 3, np.frombuffer(bits, np.uint64), 50)
        fits = [j for j, n, b in before if j % 3 != k % 3 and n * 100 >= len(grams) * 50 and jaccard_join._possible(n, b, len(grams), bits, 50)]
        assert sorted(others.tolist()) == fits and len(shares) == len(fits)
        earlier.add(len(grams), k, k % 3, np.frombuffer(bits, np.uint64))
        before.append((k, len(grams), bits))


def test_embeddings(spark, sf_dir):
    columns = ["vec_id", "n_links", "component_id", "kept"]
    table = pq.read_table(f"{sf_dir}/embeddings.parquet").to_pydict()
    whole = list(zip(table["vec_id"], table["embedding"], table["label"], strict=True))
    assert rows(queries.op2_embedding_dedup(spark, sf_dir), *columns) == sorted(brute.embeddings(whole), key=repr)
    rng = np.random.default_rng(2)
    made = [(i, c + rng.normal(0, s, 16), k % 2) for k, c in enumerate(rng.normal(0, 1, (12, 16))) for i, s in zip(range(100 * k, 100 * k + 25), [0.02, 0.1, 0.25] * 9)]
    made = [(i, [float(x) for x in v], label) for i, v, label in made]
    made += [(5000, None, 1), (5001, [0.0] * 16, 1), (5002, [float("nan")] * 16, 1), (5003, made[0][1], None), (5004, [], 1), (5005, [1.0, None], 1)]
    made += [(5006, made[0][1], 0), (5007, [2.0], 0), (5008, [3.0], 0)]
    df = spark.createDataFrame(made, "vec_id long, embedding array<double>, label int")
    assert rows(embedding_dedup.embedding_dedup(df), *columns) == sorted(brute.embeddings(made), key=repr)
    assert embedding_dedup.embedding_dedup(df.limit(0)).count() == 0


def test_embeddings_of_a_large_group(spark, monkeypatch):
    """Over a thousand different near copies, in several blocks, some of them twice: nearly all links are proven in the tiles."""
    rng = np.random.default_rng(4)
    centre = rng.normal(0, 1, 48)
    made = [(i, [float(x) for x in centre + rng.normal(0, 0.05 + 0.0002 * i, 48)], 1) for i in range(1100)]
    made += [(2000 + i, made[i][1], 1) for i in range(0, 50, 7)]
    pairs, exact = [], embedding_dedup._exact
    monkeypatch.setattr(embedding_dedup, "_exact", lambda p, *rest: (pairs.append(p), exact(p, *rest))[1])
    df = spark.createDataFrame(made, "vec_id long, embedding array<double>, label int")
    found = rows(embedding_dedup.embedding_dedup(df), "vec_id", "n_links", "component_id", "kept")
    true = {r[0]: r for r in brute.embeddings(made)}
    # No link too many; the bands may miss a pair that is barely above the threshold.
    assert len(found) == len(true) and all(r[1] <= true[r[0]][1] and r[2:] == true[r[0]][2:] for r in found)
    links = sum(r[1] for r in found) // 2
    assert links >= 0.999 * sum(r[1] for r in true.values()) // 2 > 500_000
    assert pairs[0].count() < links // 10


def test_forest():
    x, y = np.array([5, 1, 7, 2, 9]), np.array([1, 0, 2, 8, 7])
    assert embedding_dedup._forest(x, y, 11).tolist() == [0, 0, 2, 3, 4, 0, 6, 2, 2, 2, 10]
    assert embedding_dedup._forest(x[:0], y[:0], 2).tolist() == [0, 1]


def test_decontamination(spark, sf_dir, docs, awkward):
    columns = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    table = pq.read_table(f"{sf_dir}/benchmark.parquet").to_pydict()
    items = list(zip(table["item_id"], table["text"], strict=True))
    assert rows(queries.op3_decontamination(spark, sf_dir), *columns) == sorted(brute.decontaminated(docs, items), key=repr)
    items = [(1, "Two, ONE"), (10, "w3 w4 w5 w6 w7 w8 w9 w10 w11 w12 w13"), (2, None), (3, ""), (4, "the the the")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = rows(decontaminate.decontaminate(awkward, bench), *columns)
    assert distinct(found) == sorted(brute.decontaminated(UNIQUE, items), key=repr) and len(found) == len(AWKWARD)
    clean = decontaminate.decontaminate(awkward, bench, remove="documents")
    assert clean.columns == awkward.columns
    hit = {r[0] for r in brute.decontaminated(UNIQUE, items) if r[-1]}
    assert {r.doc_id for r in clean.collect()} == {r[0] for r in UNIQUE} - hit
    spans = decontaminate.decontaminate(awkward, bench, remove="spans").where("doc_id = 1").first()
    assert spans.text.split() == LONG.split()[:3] + LONG.split()[14:]
    assert decontaminate.decontaminate(awkward, bench.limit(0)).where("contaminated").count() == 0
    assert decontaminate.decontaminate(awkward.limit(0), bench).count() == 0


def test_decontamination_beyond_the_broadcast(spark, sf_dir, docs, awkward, monkeypatch):
    """Windows that are shuffled: the same rows, and what travels is narrow whatever a text's length."""
    columns = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    near = queries.op3_decontamination(spark, sf_dir)
    monkeypatch.setattr(decontaminate, "_BROADCAST_ROWS", 0)
    far = queries.op3_decontamination(spark, sf_dir)
    assert rows(far, *columns) == rows(near, *columns)
    plan = far._jdf.queryExecution().optimizedPlan().toString()
    joined = next(line for line in plan.splitlines() if "xxhash64(slice(" in line)
    assert "_kept" not in joined.split("[")[1] and "_words" not in joined.split("AS _hash")[-1]
    items = [(1, "Two, ONE"), (10, "w3 w4 w5 w6 w7 w8 w9 w10 w11 w12 w13"), (2, None), (3, ""), (4, "the the the"), (5, "v19000 v19001 v19002 v19003 v19004 v19005 v19006 v19007 v19008 v19009")]
    long = " ".join(f"v{i}" for i in range(20_000))
    bench = spark.createDataFrame(items, "item_id long, text string")
    some = awkward.select("doc_id", "text").unionByName(spark.createDataFrame([(50, long), (None, long)], "doc_id long, text string"))
    source = [*UNIQUE, (50, long), (None, long)]
    found = rows(decontaminate.decontaminate(some, bench), *columns)
    assert distinct(found) == sorted(brute.decontaminated(source, items), key=repr)
    clean = decontaminate.decontaminate(some, bench, remove="spans").where("doc_id = 50").first()
    assert len(clean.text.split()) == 19_990
    hit = {r[0] for r in brute.decontaminated(source, items) if r[-1]}
    assert {r.doc_id for r in decontaminate.decontaminate(some, bench, remove="documents").collect()} == {r[0] for r in source} - hit
    assert decontaminate.decontaminate(some, bench.limit(0)).where("contaminated").count() == 0


def mirrored():
    """The Thue-Morse word over a and b, and its mirror: equal under polynomial hashes modulo powers of two."""
    return ["".join("ab"[k.bit_count() % 2 ^ flip] for k in range(1024)) for flip in (0, 1)]


def test_different_words_have_different_hashes():
    one, two = mirrored()
    made = {one, two, *("a" * k for k in range(1, 70)), *("ab" * k for k in range(1, 40)), *(c * 8 + d * 8 for c in "abcd" for d in "abcd")}
    made |= {"".join(rotated[k:] + rotated[:k]) for rotated in ("abcdefghijklmnop" * 3,) for k in range(16)}
    whole = sorted(made)
    data = np.frombuffer(" ".join(whole).encode(), np.uint8)
    hashes, firsts = hashing.word_hashes(data, np.array([0, len(data)]), hashing.BLANKS, lower=False)
    assert len(set(hashes.tolist())) == len(whole) == firsts[-1]
    for word, value in zip(whole, hashes.tolist(), strict=True):  # wherever a word stands
        alone = np.frombuffer(f" {word}".encode(), np.uint8)
        assert hashing.word_hashes(alone, np.array([0, len(alone)]), hashing.BLANKS, lower=False)[0].tolist() == [value]
        upper = np.frombuffer(word.upper().encode(), np.uint8)
        assert hashing.word_hashes(upper, np.array([0, len(upper)]), hashing.BLANKS, lower=True)[0].tolist() == [value]


def test_mirrored_words_are_not_copies(spark):
    one, two = mirrored()
    made = [(k, " ".join([word] * 25 + [f"x{word[0]}{k}"])) for k, word in enumerate((one, two))]
    df = spark.createDataFrame(made, "doc_id long, text string")
    assert rows(jaccard_join.ngram_jaccard_join(df), "doc_id", "n_shingles", "component_id") == sorted(brute.jaccard(made), key=repr)
    columns = ["doc_id", "n_words", "n_removed", "kept_sha256"]
    assert rows(substring_dedup.substring_dedup(df), *columns) == sorted(brute.substrings(made), key=repr)


def test_substrings(spark, sf_dir, docs, awkward):
    columns = ["doc_id", "n_words", "n_removed", "kept_sha256"]
    assert rows(queries.op4_substring_dedup(spark, sf_dir), *columns) == sorted(brute.substrings(docs), key=repr)
    found = rows(substring_dedup.substring_dedup(awkward), *columns)
    assert distinct(found) == sorted(brute.substrings(UNIQUE), key=repr) and len(found) == len(AWKWARD)
    texts = substring_dedup.substring_dedup(awkward, with_text=True).where("doc_id = 2").first()
    assert texts.text == "tail"
    assert substring_dedup.substring_dedup(awkward.limit(0)).count() == 0


def test_pages(spark):
    page = (
        "<html><head><title>t</title></head><body><nav><a>Home</a></nav><div class='ad'>Buy</div><article><h1>A &amp; B</h1>"
        "<p>one <b>two</b><br>three<p>four<div class=comments><p>no</div></article><footer>f</footer>"
    )
    plain = "<body><div id='top-menu'>m</div><div class=body><p>{} text</p></div><form>x</form></body>"
    made = [(1, "http://a.example/1", page), (1, "http://a.example/1", page), (2, None, None), (3, "", "")]
    made += [(10 + k, f"http://b.example/{k}", plain.format(k)) for k in range(3)] + [(20, "http://c.example", "just text <b")]
    df = spark.createDataFrame(made, "page_id long, url string, html string")
    found = {r.page_id: (r.text, r.n_chars) for r in html_extract.extract_text(df).collect()}
    assert found[1] == ("A & B one two three four", 24) and found[2] == found[3] == ("", 0)
    assert [found[10 + k][0] for k in range(3)] == ["0 text", "1 text", "2 text"] and found[20][0] == "just text"
    assert html_extract.extract_text(df).count() == len(made)
    assert html_extract.extract_text(df.limit(0)).count() == 0


def test_token_records(spark, sf_dir, docs, awkward):
    tokenizer = Tokenizer.from_file(queries.WORD_BPE)
    columns = ["doc_id", "start", "n_tokens", "ids_crc32"]
    for df, source in ((queries.op6_token_records(spark, sf_dir), docs), (token_records.token_records(awkward, queries.WORD_BPE), [r[:2] for r in AWKWARD])):
        at, expected = 0, []
        for doc, text in sorted(source, key=lambda d: d[0]):
            ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]
            expected.append((doc, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
            at += len(ids)
        assert rows(df, *columns) == sorted(expected, key=repr)
    assert token_records.token_records(awkward.limit(0), queries.WORD_BPE).count() == 0
    record = token_records.frame(np.array([1, 70_000], np.uint32))
    assert [i.tolist() for _, i in token_records.read_frames(record)] == [[1, 70_000]]
    with pytest.raises(ValueError):
        list(token_records.read_frames(record[:-5] + b"\7" + record[-4:]))


def test_token_records_sought(spark, awkward, tmp_path, monkeypatch):
    tokenizer = Tokenizer.from_file(queries.WORD_BPE)
    expected = sorted(tokenizer.encode(t or "", add_special_tokens=False).ids + [1] for _, t, _ in AWKWARD)
    monkeypatch.setattr(token_records, "SHARD_BYTES", 200)  # several shards a part
    index = token_records.write_token_records(awkward, str(tmp_path / "a"), queries.WORD_BPE)
    assert index.select("shard").distinct().count() > 4
    shuffled = [token_records.shuffled_token_records(index, str(tmp_path / "a"), seed).collect() for seed in (1, 1, 2)]
    assert shuffled[0] == shuffled[1] != shuffled[2]
    assert all(sorted(r.ids for r in found) == expected for found in shuffled)
    one = token_records.read_token_records(index.where("id = 12"), str(tmp_path / "a")).collect()
    assert [r.ids for r in one] == [tokenizer.encode(AWKWARD[-1][1], add_special_tokens=False).ids + [1]]
    assert one[0].ids_crc32 == zlib.crc32(np.array(one[0].ids, "<u4").tobytes())
    for shard in (tmp_path / "a" / "shards").iterdir():  # records that are not asked for are not read
        if shard.name != one[0].shard:
            shard.write_bytes(b"")
    assert token_records.read_token_records(index.where("id = 12"), str(tmp_path / "a")).collect() == one
    for wrong in ("id <> 12", "id = 12"):
        moved = index.where(wrong).withColumn("offset", F.col("offset") + 1)
        with pytest.raises(Exception, match="record at"):
            token_records.read_token_records(moved, str(tmp_path / "a")).collect()


ODD_WORDS = [
    "It's", "'S", "''s", "don't'll", "l'été", "'", "a|b", "<|endoftext|>x", "<|ENDOFTEXT|>", "</w>", "ÀÉ×÷ß", "x²½", "ªºµ", "«oui»", "¿qué?",
    "a\xa0b", "so\xadft", "e\u0301", "\u0301", "İ\u212a", "中文", "😀👍🏽", "Привет", "a\x00", "\x1c", "123", "4५", "_x_", "...--", "ﬁ", "x" * 40,
]


def test_token_ids_of_slices(monkeypatch):
    """Wherever texts are cut between words, their ids are the library's."""
    tokenizer = Tokenizer.from_file(queries.WORD_BPE)
    rng = random.Random(3)
    joined = [*ODD_WORDS, " ", "\n", "\x0b\t", " , ", "The "]
    texts = [None, "", *("".join(rng.choices(joined, k=n)) for n in (1, 2, 30, 200, 0, 40)), None, " ".join(ODD_WORDS), ""]
    expected = [tokenizer.encode(t or "", add_special_tokens=False).ids + [1] for t in texts]
    batch = pa.record_batch([pa.array(range(len(texts))), pa.array(["é", *texts]).slice(1)], ["id", "text"])
    for slice_bytes, held_bytes, together in ((1, 1, 1), (3, 40, 2), (50, 300, 7), (10**6, 10**7, 2_000)):
        for name, value in (("_SLICE", slice_bytes), ("_BYTES", held_bytes), ("_TOGETHER", together), ("_ENCODERS", {})):
            monkeypatch.setattr(token_records, name, value)
        found = [ids.tolist() for _, t in token_records._gathered(iter([batch, batch])) for ids in token_records.encode_words(queries.WORD_BPE, t, 1)]
        assert found == expected * 2


def test_token_pieces_are_encoded_once(monkeypatch):
    """Distinct words that share their pieces do not cost a step of their own each."""
    monkeypatch.setattr(token_records, "_ENCODERS", {})
    texts = [" ".join(f"{a}{x},{b.upper()}{y}" for x in range(10)) for a in LONG.split()[:20] for b in ("aa", "bb", "cc") for y in range(10)]
    assert len({w for t in texts for w in t.split()}) > 1_000
    asked = []
    compute = token_records.WordEncoder._encode_pieces
    monkeypatch.setattr(token_records.WordEncoder, "_encode_pieces", lambda self, new: asked.extend(new) or compute(self, new))
    found = [ids.tolist() for ids in token_records.encode_words(queries.WORD_BPE, pa.array(texts), 1)]
    tokenizer = Tokenizer.from_file(queries.WORD_BPE)
    assert found == [tokenizer.encode(t, add_special_tokens=False).ids + [1] for t in texts]
    assert len(asked) == len(set(asked)) < 50


def test_byte_bpe(spark, sf_dir, docs, awkward):
    with open(queries.BYTE_RANKS, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    encoding = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    columns = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    encoded = byte_bpe.encode_documents(awkward, queries.BYTE_RANKS, P.PATTERN)
    for df, source in ((queries.op7_byte_bpe(spark, sf_dir), docs), (encoded, [r[:2] for r in AWKWARD])):
        expected = []
        for doc, text in source:
            ids = np.array(encoding.encode_ordinary(text or ""), "<u4")
            expected.append((doc, len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()))
        assert rows(df, *columns) == sorted(expected, key=repr)
    back = byte_bpe.decode_documents(encoded, queries.BYTE_RANKS, P.PATTERN)
    assert rows(back, "doc_id", "text") == sorted(((d, t or "") for d, t, _ in AWKWARD), key=repr)


def test_pii(spark, sf_dir, docs, awkward):
    columns = ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256"]
    assert rows(queries.op8_pii(spark, sf_dir), *columns) == sorted(brute.pii_rows(docs), key=repr)
    assert distinct(rows(pii.find_pii(awkward), *columns)) == sorted(brute.pii_rows(UNIQUE), key=repr)
    hidden = pii.find_pii(awkward, redact=True)
    assert hidden.columns == awkward.columns
    assert hidden.where("doc_id = 10").first().text == "mail [email] call [phone] at [ip] or [card] x@y"
    assert pii.find_pii(awkward.limit(0)).count() == 0


def test_pii_finds_unseen_identifiers(spark):
    known = [(k, f"so please call extension +1 (200) 555-{1000 + k} today") for k in range(12)]
    made = [*known, (50, "so please call extension 0049-17-2345 now"), (51, "we sold 0049-17-9999 of them")]
    found = {r.doc_id: r.spans for r in pii.find_pii(spark.createDataFrame(made, "doc_id long, text string")).collect()}
    assert found[50] == "phone:25:37" and found[51] == "" and found[0].startswith("phone:25:")


def test_ids_that_name_several_texts(spark):
    """Rows are compared each by its own text, however many share an id."""
    rng = random.Random(3)
    text = [[f"w{rng.randrange(10**6)}" for _ in range(60)] for _ in range(3)]
    near = [" ".join(words[:-2] + ["other", "end"]) for words in text]
    made = [(1, " ".join(text[0])), (2, " ".join(text[1])), (7, near[0]), (7, near[1]), (7, near[1]), (7, " ".join(text[2])), (9, near[2]), (None, near[0])]
    made += [(8, f"{k} " + " ".join(text[2])) for k in range(40)]
    df = spark.createDataFrame(made, "doc_id long, text string")
    found = sorted(tuple(r[c] for c in ("doc_id", "component_id")) for r in jaccard_join.ngram_jaccard_join(df.where("doc_id is not null")).collect())
    assert found == sorted([(1, 1), (2, 2), (7, 1), (7, 2), (7, 2), (7, 7), (9, 7)] + [(8, 7)] * 40)
    found = [r for r in jaccard_join.ngram_jaccard_join(df).collect() if r.doc_id is None]
    assert [(r.class_id, r.component_id) for r in found] == [(7, 1)]
    docs = df.withColumn("row_hash", F.lit("clash")).withColumn("kept", F.lit("clash"))
    left = corpus_pipeline.one_of_near_copies(spark, docs, "").collect()
    assert Counter(r.doc_id for r in left) == {1: 1, 2: 1, 7: 1, None: 1}
    assert {r.text for r in left if r.doc_id == 7} == {" ".join(text[2])}
    again = corpus_pipeline.one_of_near_copies(spark, docs.unionByName(docs), "").collect()
    assert Counter(r.doc_id for r in again) == {1: 1, 2: 1, 7: 1, None: 2}


def test_language_brute(spark, sf_dir, docs, awkward):
    langs = {r.doc_id: r.lang for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang").collect()}
    learned = [(text, langs[d]) for d, text in docs if langs[d] is not None and zlib.crc32(str(d).encode()) % 4 != 2]
    expected = brute.language(learned, [text for _, text in docs])
    found = {r.doc_id: (r.lang_pred, r.score) for r in queries.op9_language_id(spark, sf_dir).collect()}
    assert [found[d][0] for d, _ in docs] == [lang for lang, _ in expected]
    np.testing.assert_allclose([found[d][1] for d, _ in docs], [score for _, score in expected], atol=1e-9)
    texts = [t for _, t, _ in AWKWARD]
    expected = brute.language([(t, lang) for _, t, lang in AWKWARD if lang is not None], texts)
    edge = sorted(r.score for r in language_id.identify_language(awkward, awkward).collect())
    np.testing.assert_allclose(edge, sorted(score for _, score in expected), atol=1e-9)
    assert language_id.identify_language(awkward.limit(0), awkward).count() == 0


def test_language_of_long_texts(monkeypatch):
    rng = random.Random(5)
    monkeypatch.setattr(language_id, "_CHARS", 40)
    for letters in ("ab", "abcİΣß ", "xy,. 中文"):
        texts = ["".join(rng.choices(letters, k=rng.choice((0, 1, 39, 40, 41, 42, 80, 83, 500)))) for _ in range(60)]
        sums = Counter()
        for run, row, gram, count in language_id._counted(texts):
            for r, g, c in zip(row.tolist(), gram.tolist(), count.tolist(), strict=True):
                sums[run.start + r, g] += c
        row, gram, count = language_id._grams([t.lower() for t in texts])
        assert {k: c for k, c in sums.items() if c} == dict(zip(zip(row.tolist(), gram.tolist()), count.tolist()))
    monkeypatch.undo()
    text = "".join(chr(rng.randrange(0x4E00, 0x9F00)) for _ in range(100_000))  # one word of as many different 3-grams
    tracemalloc.start()
    parts = [language_id._bundles(language_id.Profiles(1024), row, gram, count, 1) for _, row, gram, count in language_id._counted([text])]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(parts) == 1 and peak < 200e6


def test_language(spark, sf_dir, awkward):
    truth = dict(zip(*pq.read_table(f"{sf_dir}/documents.parquet", columns=["doc_id", "lang"]).to_pydict().values(), strict=True))
    found = queries.op9_language_id(spark, sf_dir).collect()
    assert all(r.held_out == brute.is_held_out(r.doc_id) and 0 <= r.score <= 1 for r in found) and len(found) == len(truth)
    held = [r for r in found if r.held_out]
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) >= 0.95 * len(held)
    edge = {r.doc_id: r.lang_pred for r in language_id.identify_language(awkward, awkward).collect()}
    assert edge[4] == edge[5] == edge[6] == "und" and edge[7] in ("en", "de", "fr")
    assert {r.lang_pred for r in language_id.identify_language(awkward, awkward.limit(0)).collect()} == {"und"}


def test_quality(spark, sf_dir, awkward):
    found = queries.op10_quality(spark, sf_dir).collect()
    labels = dict(zip(*pq.read_table(f"{sf_dir}/labels.parquet", columns=["doc_id", "quality"]).to_pydict().values(), strict=True))
    held = [r for r in found if r.held_out and r.doc_id in labels]
    assert sum(r.predicted == labels[r.doc_id] for r in held) >= 0.85 * len(held)
    assert all(0 <= r.score <= 1 and r.held_out == brute.is_held_out(r.doc_id) for r in found)
    few = spark.createDataFrame([(1, 1), (9, 0), (7, None), (99, 1)], "doc_id long, quality int")
    assert quality.score_quality(awkward, few).count() == len(AWKWARD)
    assert {r.score for r in quality.score_quality(awkward, few.limit(0)).collect()} == {1.0}
    assert quality.score_quality(awkward.limit(0), few).count() == 0
    levels = quality.isotonic(np.array([[2, 0], [2, 2], [2, 1], [0, 0], [2, 2]], float))[1].tolist()
    assert levels == [0.0, 0.75, 0.75, 1.0]


def test_pipeline(spark, sf_dir):
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert len(names) == 5 and corpus_pipeline.ORACLE_SQL is None
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    kept = corpus_pipeline.good_quality(spark, docs, sf_dir).cache()
    near = corpus_pipeline.one_of_near_copies(spark, kept, sf_dir).cache()
    clean = corpus_pipeline.without_benchmarks(spark, near, sf_dir).cache()
    assert kept.columns == near.columns == clean.columns == docs.columns
    source = [(r.doc_id, r.text) for r in kept.collect()]
    expected = {d for d, _, c in brute.jaccard(source) if d == c}
    assert {r.doc_id for r in near.collect()} == expected
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    pure = {r[0] for r in brute.decontaminated([s for s in source if s[0] in expected], items) if not r[-1]}
    assert {r.doc_id for r in clean.collect()} == pure
    hidden = {r.doc_id: r for r in corpus_pipeline.without_pii(spark, clean, sf_dir).collect()}
    assert set(hidden) == pure and all(not brute.base_pii(r.text) and r.n_chars == len(r.text) for r in hidden.values())
    last = corpus_pipeline.run(spark, sf_dir).collect()
    assert {(r.doc_id, r.decoded_sha256) for r in last} == {(d, hashlib.sha256(r.text.encode()).hexdigest()) for d, r in hidden.items()}
