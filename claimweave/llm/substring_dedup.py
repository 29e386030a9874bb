"""Substring deduplication with suffix automata of reference documents.

A window of ``length`` words is removed when the same words start earlier in the
corpus. Sending every document through an automaton of all others would be
quadratic, so documents are first routed: among the word n-grams of every window
the one with the smallest hash is its anchor, so equal windows have equal
anchors. The smallest document with an anchor is the reference of all windows
with that anchor. The reference's windows become a suffix automaton, and the
other documents routed to it stream past it for matching statistics: a window
ending where the statistic reaches ``length`` has occurred in the reference. An
automaton never holds more than one document, and the documents of a busy
reference are split over several tasks, each with the automaton of its own.

Windows that are not in the reference but may recur among the later documents
are settled by an aggregate over their hashes.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from claimweave.llm.hashing import BLANKS, run_hashes, text_buffers, word_hashes, word_spans
from claimweave.storage import cut_lineage

#: Words of an anchor, for windows that are longer than that; shorter windows are their own anchors.
_ANCHOR = 10
#: Documents of one reference that one task takes.
_PER_TASK = 256
#: Ids that are broadcast at most (16 MB as a hashed relation); more are shuffled.
_BROADCAST_IDS = 1_000_000
_EMPTY = hashlib.sha256(b"").hexdigest()


class SuffixAutomaton:
    """Suffix automaton over a sequence of integers, grown one at a time."""

    def __init__(self):
        self.next: list[dict[int, int]] = [{}]
        self.link, self.size, self.last = [-1], [0], 0

    def extend(self, c: int) -> int:
        """Append ``c``; the length of the longest suffix that has occurred before."""
        nexts, link, size = self.next, self.link, self.size
        new = len(nexts)
        nexts.append({})
        size.append(size[self.last] + 1)
        link.append(0)
        p = self.last
        while p >= 0 and c not in nexts[p]:
            nexts[p][c] = new
            p = link[p]
        if p >= 0:
            q = nexts[p][c]
            if size[q] != size[p] + 1:
                copy = len(nexts)
                nexts.append(dict(nexts[q]))
                size.append(size[p] + 1)
                link.append(link[q])
                while p >= 0 and nexts[p].get(c) == q:
                    nexts[p][c] = copy
                    p = link[p]
                link[q] = copy
                q = copy
            link[new] = q
        self.last = new
        return size[link[new]]

    def statistics(self, words: list[int]) -> list[int]:
        """For each word the length of the longest run ending there that occurs in the sequence."""
        nexts, link, size = self.next, self.link, self.size
        state, matched, out = 0, 0, []
        for c in words:
            while state and c not in nexts[state]:
                state = link[state]
                matched = size[state]
            if c in nexts[state]:
                state = nexts[state][c]
                matched += 1
            out.append(matched)
        return out


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` consecutive values."""
    done = 1
    while done < width:
        step = min(done, width - done)
        values = np.minimum(values[:-step], values[step:])
        done += step
    return values


def _anchors(words: np.ndarray, length: int) -> np.ndarray:
    """The anchor of every window of ``length`` words."""
    grams = run_hashes(words, min(_ANCHOR, length))
    return _least(grams, length - min(_ANCHOR, length) + 1) if len(words) >= length else grams[:0]


def _profile(docs: DataFrame, length: int) -> DataFrame:
    """id, n_words, key of the word sequence, hash of all words, distinct anchors and which of them occur apart."""

    def profile(batches):
        for batch in batches:
            n_words, keys, shas, anchors, recurs = [], [], [], [], []
            for _, data, offsets in text_buffers(batch.column(1)):
                words, firsts = word_hashes(data, offsets, BLANKS, lower=False)
                starts, ends, _ = word_spans(data, offsets, BLANKS)
                for i in range(len(offsets) - 1):
                    a, b = firsts[i], firsts[i + 1]
                    n_words.append(int(b - a))
                    raw = data[offsets[i] : offsets[i + 1]].tobytes()
                    shas.append(hashlib.sha256(b" ".join(raw.split())).hexdigest())
                    own = _anchors(words[a:b], length)
                    keys.append(hashlib.blake2b(words[a:b].tobytes(), digest_size=16).digest() if b > a else None)
                    # An anchor recurs if windows that have it do not all hold the same place of it.
                    values, counts = np.unique(own, return_counts=True)
                    grams = run_hashes(words[a:b], min(_ANCHOR, length)) if len(values) else own
                    places = grams[np.isin(grams, values)]
                    again, times = np.unique(places, return_counts=True)
                    anchors.append(values.view(np.int64))
                    recurs.append(times > 1)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n_words, pa.int64()), pa.array(keys, pa.binary()), pa.array(shas, pa.string()),
                 pa.array(anchors, pa.list_(pa.int64())), pa.array([r.tolist() for r in recurs], pa.list_(pa.bool_()))],
                ["id", "n_words", "key", "sha", "anchors", "recurs"],
            )

    kind = docs.schema["id"].dataType.simpleString()
    return docs.mapInArrow(
        profile, f"id {kind}, n_words long, key binary, sha string, anchors array<long>, recurs array<boolean>"
    )


def _routes(profiles: DataFrame) -> DataFrame:
    """Per document the anchors that occur elsewhere too, each with its reference document."""
    rows = profiles.select("id", F.explode(F.arrays_zip("anchors", "recurs")).alias("x"))
    over = Window.partitionBy("anchor")
    rows = rows.select("id", F.col("x.anchors").alias("anchor"), F.when(F.col("x.recurs"), 2).otherwise(1).alias("n"))
    again = rows.withColumn("total", F.sum("n").over(over)).withColumn("reference", F.min("id").over(over))
    return again.where("total > 1").select("id", "anchor", "reference")


def _segments(texts: DataFrame, length: int) -> DataFrame:
    """Runs of routed windows: (reference, id, start, words); texts have id, text, anchors, refs."""

    def cut(batches):
        for batch in batches:
            out = [], [], [], []
            anchors, refs = batch.column(2).to_pylist(), batch.column(3).to_pylist()
            ids = batch.column(0).to_pylist()
            for first, data, offsets in text_buffers(batch.column(1)):
                words, firsts = word_hashes(data, offsets, BLANKS, lower=False)
                for i in range(len(offsets) - 1):
                    row = first + i
                    known = np.array(anchors[row], np.int64).view(np.uint64)
                    order = np.argsort(known)
                    known, to = known[order], np.array(refs[row])[order]
                    own_words = words[firsts[i] : firsts[i + 1]]
                    own = _anchors(own_words, length)
                    place = np.minimum(np.searchsorted(known, own), len(known) - 1)
                    starts = np.flatnonzero(known[place] == own)
                    target = to[place[starts]]
                    if not len(starts):
                        continue
                    new = np.append(True, (np.diff(starts) > 1) | (target[1:] != target[:-1]))
                    for a, b in zip(np.flatnonzero(new), np.append(np.flatnonzero(new)[1:], len(starts)), strict=True):
                        out[0].append(target[a].item()), out[1].append(ids[row]), out[2].append(int(starts[a]))
                        out[3].append(own_words[starts[a] : starts[b - 1] + length].tobytes())
            kind = batch.column(0).type
            yield pa.RecordBatch.from_arrays(
                [pa.array(out[0], kind), pa.array(out[1], kind), pa.array(out[2], pa.int64()), pa.array(out[3], pa.binary())],
                ["reference", "id", "start", "words"],
            )

    kind = texts.schema["id"].dataType.simpleString()
    return texts.mapInArrow(cut, f"reference {kind}, id {kind}, start long, words binary")


def _match(segments: DataFrame, length: int) -> DataFrame:
    """Window starts per segment: (id, start, stop, gram); gram is null for runs found in the reference.

    Rows come sorted by reference and task share, the reference's own rows first.
    """

    def match(batches):
        at, automaton, separator = None, SuffixAutomaton(), 0
        for batch in batches:
            ids, starts, stops, grams = [], [], [], []
            rows = (batch.column(c).to_pylist() for c in ("reference", "share", "own", "id", "start", "words"))
            for reference, share, own, doc, start, raw in zip(*rows, strict=True):
                if (reference, share) != at:
                    at, automaton, separator = (reference, share), SuffixAutomaton(), 0
                hashes = np.frombuffer(raw, np.uint64)
                words = hashes.view(np.int64).tolist()
                if own:
                    separator += 1
                    automaton.extend(-(2**63) - separator)  # no word hash as int64 is that small
                    lengths = [automaton.extend(c) for c in words]
                    if share:
                        continue  # the first share reports for the reference
                else:
                    lengths = automaton.statistics(words)
                hit = np.array(lengths[length - 1 :]) >= length
                edges = np.flatnonzero(np.diff(np.concatenate([[0], hit.astype(np.int8), [0]])))
                for a, b in edges.reshape(-1, 2).tolist():
                    ids.append(doc), starts.append(start + a), stops.append(start + b), grams.append(None)
                if not own and not hit.all():
                    runs = run_hashes(hashes, length).view(np.int64)
                    for k in np.flatnonzero(~hit).tolist():
                        ids.append(doc), starts.append(start + k), stops.append(start + k + 1), grams.append(int(runs[k]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, batch.column("id").type), pa.array(starts, pa.int64()), pa.array(stops, pa.int64()), pa.array(grams, pa.int64())],
                ["id", "start", "stop", "gram"],
            )

    kind = segments.schema["id"].dataType.simpleString()
    return segments.select("reference", "share", "own", "id", "start", "words").mapInArrow(
        match, f"id {kind}, start long, stop long, gram long"
    )


def repeated_spans(docs: DataFrame, profiles: DataFrame, length: int) -> DataFrame:
    """``(id, spans)``: per document the runs [start, stop) of starts of windows that also start earlier.

    ``docs`` has id and text, ``profiles`` are their stored profiles without copies.
    """
    spark = docs.sparkSession
    routes = _routes(profiles).groupBy("id").agg(F.collect_list("anchor").alias("anchors"), F.collect_list("reference").alias("refs"))
    routes = cut_lineage(routes)
    texts = docs.join(_bounded(routes.select("id")), "id", "left_semi").dropDuplicates(["id"]).join(routes, "id")
    segments = cut_lineage(_segments(texts.select("id", "text", "anchors", "refs"), length))

    shares = segments.groupBy("reference").agg(F.ceil(F.approx_count_distinct("id") / _PER_TASK).alias("shares"))
    split = segments.join(shares, "reference").withColumn("own", F.col("id") == F.col("reference"))
    everywhere = F.sequence(F.lit(0).cast("long"), F.col("shares") - 1)
    one = F.array(F.pmod(F.xxhash64("id"), F.col("shares")))
    split = split.withColumn("share", F.explode(F.when(F.col("own"), everywhere).otherwise(one)))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    placed = split.repartition(parts, "reference", "share").sortWithinPartitions("reference", "share", F.desc("own"), "id", "start")
    found = cut_lineage(_match(placed, length))

    left = found.where("gram is not null").select("gram", "id", "start")
    first = left.groupBy("gram").agg(F.min(F.struct("id", "start")).alias("first"), F.count("*").alias("n")).where("n > 1")
    later = left.join(first, "gram").where((F.col("id") != F.col("first.id")) | (F.col("start") != F.col("first.start")))
    spans = found.where("gram is null").select("id", "start", "stop")
    spans = spans.unionByName(later.select("id", "start", (F.col("start") + 1).alias("stop")))
    return cut_lineage(spans.groupBy("id").agg(F.sort_array(F.collect_set(F.struct("start", "stop"))).alias("spans")))


def _bounded(ids: DataFrame) -> DataFrame:
    return F.broadcast(ids) if ids.count() <= _BROADCAST_IDS else ids


def substring_dedup(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 20, with_text: bool = False
) -> DataFrame:
    """``(id, n_words, n_removed, kept_sha256)`` and on request ``text``, one row per row of ``docs``.

    Words are runs of non-blank bytes, unchanged. A word is removed when a window
    of ``length`` words of its document covers it whose words also start earlier:
    in a document with a smaller id or earlier in the same one. Windows are
    judged on the input. ``kept_sha256`` is over the kept words joined by blanks,
    as is ``text``. Windows are compared by 64-bit hashes of their words.

    Null and empty texts have no words; texts below ``length`` words stay whole.
    Rows without an id keep their words and are nobody's source. Rows that share
    an id do not count as earlier than each other and get the same decisions.
    """
    base = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    profiles = cut_lineage(_profile(base, length))
    firsts = profiles.where("id is not null and key is not null").groupBy("key").agg(F.min("id").alias("first"))
    profiles = cut_lineage(profiles.join(firsts, "key", "left"))
    reps = profiles.where("id = first").dropDuplicates(["id"])
    spans = repeated_spans(base.where("id is not null"), reps, length)

    def rewrite(batches):
        for batch in batches:
            removed, shas, kept_texts = [], [], []
            all_spans = batch.column("spans").to_pylist()
            row = 0
            for raw in batch.column("text").cast(pa.binary()).to_pylist():
                words = (raw or b"").split()
                gone = np.zeros(len(words) + 1, np.int32)
                for span in all_spans[row]:
                    if span["start"] + length <= len(words):
                        gone[span["start"]] += 1
                        gone[min(span["stop"] - 1 + length, len(words))] -= 1
                keep = np.cumsum(gone)[:-1] <= 0
                kept = b" ".join(w for w, k in zip(words, keep.tolist(), strict=True) if k)
                removed.append(int((~keep).sum())), shas.append(hashlib.sha256(kept).hexdigest())
                kept_texts.append(kept.decode())
                row += 1
            out = [batch.column("id"), batch.column("n_words"), pa.array(removed, pa.int64()), pa.array(shas, pa.string())]
            names = ["id", "n_words", "n_removed", "kept_sha256"]
            if with_text:
                out, names = [*out, pa.array(kept_texts, pa.string())], [*names, "text"]
            yield pa.RecordBatch.from_arrays(out, names)

    kind = base.schema["id"].dataType.simpleString()
    copy = (F.col("id") > F.col("first")) & (F.col("n_words") >= length)
    state = profiles.select("id", "n_words", "sha", F.coalesce(copy, F.lit(False)).alias("copy"))
    kind += ", n_words long, n_removed long, kept_sha256 string" + ", text string" * with_text
    if with_text:
        facts = state.where("id is not null").dropDuplicates(["id"]).join(spans, "id", "left")
        whole = F.array(F.struct(F.lit(0).cast("long").alias("start"), (F.col("n_words") - length + 1).alias("stop")))
        none = F.expr("cast(array() as array<struct<start:bigint,stop:bigint>>)")
        facts = facts.withColumn("spans", F.when(F.col("copy"), whole).otherwise(F.coalesce("spans", none)))
        joined = base.where("id is not null").join(facts, "id").select("id", "text", "n_words", "spans")
        out = joined.mapInArrow(rewrite, f"id {kind}")
        nothing = F.lit(None).cast("long").alias("n_words"), F.lit(0).cast("long").alias("n_removed")
        loose = base.where("id is null").select("id", *nothing, F.lit(None).cast("string").alias("kept_sha256"), "text")
        return out.unionByName(loose).withColumnRenamed("id", id_col)
    partly = base.where("id is not null").join(_bounded(spans.select("id")), "id", "left_semi")
    partly = partly.join(spans, "id").withColumn("n_words", F.lit(0).cast("long"))
    partly = partly.select("id", "text", "n_words", "spans").mapInArrow(rewrite, f"id {kind}")
    partly = partly.select("id", "n_removed", "kept_sha256").dropDuplicates(["id"])
    done = state.join(partly, "id", "left")
    return done.select(
        F.col("id").alias(id_col),
        "n_words",
        F.when(F.col("copy"), F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0).cast("long"))).alias("n_removed"),
        F.when(F.col("copy"), F.lit(_EMPTY)).otherwise(F.coalesce("kept_sha256", "sha")).alias("kept_sha256"),
    )
