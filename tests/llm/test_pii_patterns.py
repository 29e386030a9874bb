"""What is learned about personal data does not depend on how many contexts there are."""

import pytest

from claimweave.llm import pii, queries


@pytest.fixture(scope="module", autouse=True)
def importable(spark):
    queries.reachable(spark)


def test_any_number_of_patterns(spark, monkeypatch):
    """Contexts beyond the broadcast are joined: same spans and texts, also for rarer contexts than those of plain numbers."""
    made = [(k, f"so please call extension +1 (200) 555-{1000 + k} today") for k in range(12)]
    made += [(20 + k, f"write to desk a{k}@b.example now") for k in range(6)]
    made += [(100 * w + k, f"item w{w} {100_000 + 997 * w + k} sold") for w in range(1, 8) for k in range(30)]
    made += [(5000, "so please call extension 0049-17-2345 now"), (5001, "write to desk q-99887766 now")]
    made += [(5000, "so please call extension 0049-17-2345 now"), (None, "write to desk q-99887766 now"), (5002, None), (5003, "")]
    df = spark.createDataFrame(made, "doc_id long, text string")

    def both():
        spans = sorted(map(tuple, pii.find_pii(df).collect()), key=repr)
        return spans, sorted(map(tuple, pii.find_pii(df, redact=True).collect()), key=repr)

    monkeypatch.setattr(pii, "MAX_PATTERNS", 10**9, raising=False)
    few = both()
    for name in ("BROADCAST_PATTERNS", "MAX_PATTERNS"):
        monkeypatch.setattr(pii, name, 1, raising=False)
    many = both()
    assert many == few
    found = {r[0]: r[-1] for r in many[0]}
    assert found[5000] == "phone:25:37" and found[5001] == "email:14:24"
    assert [r for r in many[1] if r[0] is None] == [(None, "write to desk [email] now")]


def test_contexts_that_touch_the_identifier(spark):
    far = "y" * 200
    made = [(k, f"reach our clerk tel:+1 (200) 555-{1000 + k} today") for k in range(8)]
    made += [(20 + k, f"written by <a{k}@b.example> now") for k in range(8)]
    made += [(40 + k, f"{far} +1 (200) 556-{1000 + k} today") for k in range(8)]
    made += [(100, "fax or tel:0049-17-2345 now"), (101, "written by (q-99887766) now"), (102, 'written by "q-99887766", now')]
    made += [(103, f"{far} 0049-17-2345 now"), (104, "written by " + "1234-" * 20 + "9 now"), (105, "see http://x.example/123456 now")]
    found = {r.doc_id: r.spans for r in pii.find_pii(spark.createDataFrame(made, "doc_id long, text string")).collect()}
    assert found[100] == "phone:11:23" and found[101] == "email:12:22" and found[102] == "email:12:22"
    assert found[103] == "phone:201:213" and found[104] == "email:11:112" and found[105] == ""


def test_one_rule_cuts_words():
    text = "Call me, e-mail: <a@b.c> v10.0.0.1"
    assert pii._patterns(text, text.index("a@b")) == [b"mail", b"e mail"]
    assert pii._patterns(text, text.index("10.0")) == [b"c", b"b c"]
    assert pii._patterns("x" * 500 + " tel:+12", 505) == [b"tel", b"x" * 500 + b" tel"] and pii._patterns("+12", 0) == []


def test_chains_of_patterns(spark):
    """Each context is learned from what the one before has found, seven times over."""
    words = ["amber", "birch", "cedar", "delta", "ember", "fjord", "grove"]
    group = [[f"+1 (200) 555-{1000 + i}" for i in range(5)], *([f"77{g}-{i}234" for i in range(5)] for g in range(1, 8))]
    texts = [f"{w} {x} end" for k, w in enumerate(words) for x in [*group[k], *group[k], *group[k + 1]]]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r.doc_id: r.spans for r in pii.find_pii(df).collect()}
    assert all(found[k] == f"phone:6:{len(text) - 4}" for k, text in enumerate(texts))
