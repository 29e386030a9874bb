"""Personal data by base forms and by bootstrapped contexts.

Base forms (e-mail, IP address, card and phone numbers) seed the method: the
words before seed entities are candidate patterns, other identifier-shaped
tokens are candidate instances, and the table of how often a pattern precedes
an instance is a bipartite graph. Spark scores it in rounds: a pattern counts
when enough distinct known instances follow it and they are most of what
follows it anywhere in the corpus, whatever it is; the instances of counting
patterns become known and induce patterns in turn. The surviving patterns mark
unseen identifiers in a last pass over the texts.
"""

from __future__ import annotations

import hashlib
import re
import uuid
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimweave.llm.hashing import NOT_ALNUM, run_hashes, text_buffers, word_hashes
from claimweave.storage import cut_lineage

#: Kinds in the order that breaks ties between spans with equal starts.
KINDS = ("email", "ip", "card", "phone")
_LOCAL = frozenset(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-".decode())
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_EDGES = ".,;:!?\"'()[]{}<>|*#$%&"
#: Digits and characters that an identifier-shaped token has.
_MIN_DIGITS, _MIN_CHARS = 4, 6
#: A label that is glued to the token it names, as in tel:0049-17-2345, but not the scheme of an address.
_LABEL = re.compile(r"[A-Za-z_-]+[:=](?!//)")
#: Words of patterns, as NOT_ALNUM cuts them in whole texts.
_WORD = re.compile(r"[0-9A-Za-z\x80-\U0010ffff]+")
#: Patterns that are broadcast at most; more are joined by a shuffle, with the same result.
BROADCAST_PATTERNS = 500_000


def _luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c)
        if k % 2:
            d = d * 2 - 9 * (d > 4)
        total += d
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """``(start, end, kind)`` in code points; per kind leftmost and non-overlapping."""
    found = []
    at, free = text.find("@"), 0
    while at >= 0:  # from each @ outwards, as a scan from every start would be quadratic
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            free = domain.end()
            found.append((start, free, "email"))
        at = text.find("@", max(at + 1, free))
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split(".")):
            found.append((*m.span(), "ip"))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 14:
            digits = re.sub(r"[ -]", "", m.group())
            if 14 <= len(digits) <= 19 and _luhn(digits):
                found.append((*m.span(), "card"))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 10 <= sum("0" <= c <= "9" for c in m.group()) <= 15:
                found.append((*m.span(), "phone"))
    found.sort(key=lambda s: (s[0], KINDS.index(s[2])))
    return found


def other_tokens(text: str, base: list[tuple[int, int, str]]) -> Iterator[tuple[int, int]]:
    """Identifier-shaped tokens that touch no base span."""
    end, covers, k = 0, [], 0
    for s in base:  # merged, to step along
        if covers and s[0] < covers[-1][1]:
            covers[-1] = (covers[-1][0], max(covers[-1][1], s[1]))
        else:
            covers.append((s[0], s[1]))
    m = _DIGIT.search(text)
    while m:
        start, stop = m.start(), m.end()
        while start > end and not text[start - 1].isspace():
            start -= 1
        while stop < len(text) and not text[stop].isspace():
            stop += 1
        end = stop
        while stop > start and text[stop - 1] in _EDGES:
            stop -= 1
        while start < stop and text[start] in _EDGES:
            start += 1
        label = _LABEL.match(text, start, stop)
        if label:
            start = label.end()
            while start < stop and text[start] in _EDGES:
                start += 1
        while k < len(covers) and covers[k][1] <= start:
            k += 1
        clear = k == len(covers) or covers[k][0] >= stop
        if clear and stop - start >= _MIN_CHARS and sum("0" <= c <= "9" for c in text[start:stop]) >= _MIN_DIGITS:
            yield start, stop
        m = _DIGIT.search(text, end)


def _before(text: str, start: int) -> bytes | None:
    """The two words before ``start``, lower-cased; None without any. A word that runs on into the entity is none."""
    glued = 0 < start < len(text) and _WORD.fullmatch(text, start - 1, start + 1) is not None
    size = 80
    while True:
        at = max(0, start - size)
        left = _WORD.findall(text, at, start)
        if at == 0 or len(left) > 2 + glued:  # the first one may have been cut
            break
        size *= 4
    left = left[: len(left) - glued][-2:]
    return " ".join(left).encode().lower() if left else None


def _patterns(text: str, start: int) -> list[bytes]:
    """Patterns that an entity at ``start`` induces: the word before it and the two words before it."""
    two = _before(text, start)
    if not two:
        return []
    return [two] if b" " not in two else [two.split(b" ")[1], two]


def _pattern_hashes(patterns: list[bytes]) -> np.ndarray:
    """The hashes that the same one or two words have when a whole text is hashed."""
    if not patterns:
        return np.empty(0, np.int64)
    column = pa.array(patterns, pa.large_binary())
    out = []
    for _, data, offsets in text_buffers(column):
        words, firsts = word_hashes(data, offsets, NOT_ALNUM, lower=True)
        sizes = np.diff(firsts)
        one, two = run_hashes(words, 1), run_hashes(words, 2)
        hashes = one[firsts[:-1]]
        pairs = sizes == 2
        hashes[pairs] = two[firsts[:-1][pairs]]
        out.append(hashes)
    return np.concatenate(out).view(np.int64)


def _graph(docs: DataFrame) -> DataFrame:
    """Edges (pattern, instance, kind, n) with a null kind for instances that are not base entities."""

    def edges(batches):
        for batch in batches:
            counted = Counter()
            for text in batch.column(0).to_pylist():
                if not text:
                    continue
                base = base_spans(text)
                entities = [(s, e, kind) for s, e, kind in base] + [(s, e, None) for s, e in other_tokens(text, base)]
                for start, end, kind in entities:
                    instance = hashlib.blake2b(text[start:end].lower().encode(), digest_size=8).digest()
                    for pattern in _patterns(text, start):
                        counted[pattern, int.from_bytes(instance, "little", signed=True), kind] += 1
            keys = list(counted)
            yield pa.RecordBatch.from_arrays(
                [pa.array(_pattern_hashes([k[0] for k in keys])), pa.array([k[1] for k in keys], pa.int64()),
                 pa.array([k[2] for k in keys], pa.string()), pa.array(list(counted.values()), pa.int64())],
                ["pattern", "instance", "kind", "n"],
            )

    found = docs.mapInArrow(edges, "pattern long, instance long, kind string, n long")
    return found.groupBy("pattern", "instance", "kind").agg(F.sum("n").alias("n"))


def _totals(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """How often each pattern of ``wanted`` occurs before any word, over all documents."""
    few = wanted.count() <= BROADCAST_PATTERNS
    patterns = wanted.toPandas()["pattern"].to_numpy(np.int64) if few else np.empty(0, np.int64)
    shared = docs.sparkSession.sparkContext.broadcast(np.sort(patterns))

    def runs_of(column):
        for _, data, offsets in text_buffers(column):
            words, firsts = word_hashes(data, offsets, NOT_ALNUM, lower=True)
            last = np.zeros(len(words), bool)
            last[firsts[1:][firsts[1:] > firsts[:-1]] - 1] = True
            inside = ~last[:-1]  # runs of two must not cross documents
            yield run_hashes(words, 1)[~last].view(np.int64)
            if len(words) > 1:
                yield run_hashes(words, 2)[inside & ~last[1:]].view(np.int64)

    def count_known(batches):
        known = shared.value
        sums = np.zeros(len(known), np.int64)
        for batch in batches:
            for runs in runs_of(batch.column(0)):
                if len(known):
                    at = np.minimum(np.searchsorted(known, runs), len(known) - 1)
                    sums += np.bincount(at[known[at] == runs], minlength=len(known))
        seen = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(known[seen]), pa.array(sums[seen])], ["pattern", "total"])

    def count_all(batches):
        for batch in batches:
            for runs in runs_of(batch.column(0)):
                seen, sums = np.unique(runs, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(sums.astype(np.int64))], ["pattern", "total"])

    found = docs.mapInArrow(count_known if few else count_all, "pattern long, total long")
    if not few:
        found = found.join(wanted, "pattern", "left_semi")
    return found.groupBy("pattern").agg(F.sum("total").alias("total"))


def _known(graph: DataFrame) -> DataFrame:
    return graph.where("kind is not null").select("instance", F.col("kind").alias("as_kind")).distinct()


def _reachable(graph: DataFrame, support: int) -> DataFrame:
    """Patterns that could count in any round, whatever their totals: enough known instances follow them."""
    known, size = _known(graph), -1
    while True:
        hits = graph.join(known, "instance").groupBy("pattern", "as_kind").agg(F.count_distinct("instance").alias("instances"))
        able = cut_lineage(hits.where(F.col("instances") >= support).select("pattern", "as_kind"))
        before, size = size, able.count()
        if size == before:  # the sets only grow
            return able.select("pattern").distinct()
        new = graph.where("kind is null").join(able, "pattern").select("instance", "as_kind")
        known = cut_lineage(known.unionByName(new).distinct())


def bootstrap(docs: DataFrame, support: int = 5, confidence: float = 0.6) -> dict[int, str] | DataFrame:
    """Patterns that count, with the kind of most of their known instances; ``docs`` has text alone.

    Rounds go on until one finds no instance that is not known; as what is known
    only grows, they end. More patterns than a broadcast may hold stay a table
    (pattern, as_kind).
    """
    graph = cut_lineage(_graph(docs))
    wanted = cut_lineage(_reachable(graph, support))
    if wanted.isEmpty():
        return {}
    totals = cut_lineage(_totals(docs, wanted))
    graph = cut_lineage(graph.join(totals, "pattern"))
    known = cut_lineage(_known(graph))
    size = known.count()
    while True:
        hits = graph.join(known, "instance").groupBy("pattern", "as_kind", "total")
        hits = hits.agg(F.sum("n").alias("hits"), F.count_distinct("instance").alias("instances"))
        good = hits.where((F.col("instances") >= support) & (F.col("hits") >= confidence * F.col("total")))
        best = good.groupBy("pattern").agg(F.max_by("as_kind", F.struct("hits", "as_kind")).alias("as_kind"))
        accepted = cut_lineage(best)
        if accepted.isEmpty():
            break
        new = graph.where("kind is null").join(accepted, "pattern").select("instance", "as_kind")
        known = cut_lineage(known.unionByName(new).distinct())
        before, size = size, known.count()
        if size == before:
            break
    if accepted.count() > BROADCAST_PATTERNS:
        return accepted
    return {row[0]: row[1] for row in accepted.collect()}


def _with_learned(docs: DataFrame, text_col: str, accepted: DataFrame, name: str) -> DataFrame:
    """``docs`` and, as ``name``, those patterns of ``accepted`` that occur before tokens of the row's text."""

    def needs(batches):
        for batch in batches:
            keys, owned = [], []
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                found = {p for s, _ in other_tokens(text, base_spans(text)) for p in _patterns(text, s)}
                keys += [key] * len(found)
                owned += found
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), pa.array(_pattern_hashes(owned))], ["key", "pattern"])

    key = F.sha2(F.col(text_col), 256)
    texts = docs.where(F.col(text_col) != "").select(key.alias("key"), F.col(text_col).alias("text"))
    needed = texts.mapInArrow(needs, "key string, pattern long").distinct()
    learned = needed.join(accepted, "pattern").groupBy("key").agg(F.collect_list(F.struct("pattern", "as_kind")).alias(name))
    learned = cut_lineage(learned.withColumnRenamed("key", f"{name}_key"))
    return docs.join(learned, key == F.col(f"{name}_key"), "left").drop(f"{name}_key")


def _all_spans(text: str, patterns: dict[int, str]) -> tuple[list, list]:
    base = base_spans(text)
    if not patterns:
        return base, base
    tokens = list(other_tokens(text, base))
    owned = [(s, e, p) for s, e in tokens for p in _patterns(text, s)]
    hashes = _pattern_hashes([p for _, _, p in owned]).tolist()
    added = {}
    for (start, end, _), pattern in zip(owned, hashes, strict=True):
        if pattern in patterns:
            added[start, end] = patterns[pattern]  # the longer pattern comes last
    every = sorted([*base, *((s, e, kind) for (s, e), kind in added.items())], key=lambda s: (s[0], KINDS.index(s[2])))
    return base, every


def _spelled(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in spans)


def find_pii(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    patterns: dict[int, str] | DataFrame | None = None,
    redact: bool = False,
) -> DataFrame:
    """Spans of personal data per row: (id, n_email, n_ip, n_card, n_phone, base_sha256, spans).

    The counts and the hash are over the base forms, ``spans`` (kind:start:end,
    code points, by start) also has what the learned patterns add. Patterns are
    learned from ``docs`` unless given. With ``redact=True`` the result is
    ``docs`` with every span replaced by its kind in brackets.

    Null and empty texts have no spans; a null text stays null when redacted.
    Rows are judged one by one, so repeated rows and rows without an id need no
    care. Extra columns are ignored, or kept when rows are returned.
    """
    if patterns is None:
        patterns = bootstrap(docs.select(F.col(text_col).alias("text")))
    columns, schema = docs.columns, docs.schema
    joined = isinstance(patterns, DataFrame)
    if joined:
        docs = _with_learned(docs, text_col, patterns, learned := f"learned_{uuid.uuid4().hex}")
    shared = docs.sparkSession.sparkContext.broadcast({} if joined else patterns)

    def learned_of(batch):
        """The patterns to look for, row by row."""
        if not joined:
            return [shared.value] * batch.num_rows
        return [{p["pattern"]: p["as_kind"] for p in found or ()} for found in batch.column(batch.num_columns - 1).to_pylist()]

    def mask(text, known):
        if not text:
            return text
        out, at = [], 0
        for start, end, kind in _all_spans(text, known)[1]:
            if start >= at:
                out += [text[at:start], f"[{kind}]"]
            at = max(at, end)
        return "".join([*out, text[at:]])

    def hide(batches):
        place = columns.index(text_col)
        for batch in batches:
            texts = batch.column(place).to_pylist()
            hidden = pa.array([mask(t, known) for t, known in zip(texts, learned_of(batch), strict=True)], pa.string())
            kept = batch.columns[: len(columns)]
            yield pa.RecordBatch.from_arrays([hidden if k == place else c for k, c in enumerate(kept)], columns)

    def spans(batches):
        for batch in batches:
            counts, shas, spelled = [[] for _ in KINDS], [], []
            for text, known in zip(batch.column(1).to_pylist(), learned_of(batch), strict=True):
                base, every = _all_spans(text or "", known)
                for k, kind in enumerate(KINDS):
                    counts[k].append(sum(s[2] == kind for s in base))
                shas.append(hashlib.sha256(_spelled(base).encode()).hexdigest()), spelled.append(_spelled(every))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, pa.int64()) for c in counts), pa.array(shas, pa.string()), pa.array(spelled, pa.string())],
                ["id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans"],
            )

    if redact:
        return docs.mapInArrow(hide, schema)
    kind = schema[id_col].dataType.simpleString()
    schema = f"id {kind}, " + ", ".join(f"n_{k} long" for k in KINDS) + ", base_sha256 string, spans string"
    base = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), *([learned] if joined else []))
    return base.mapInArrow(spans, schema).withColumnRenamed("id", id_col)
