"""URL filters: rules by host and path, and a tree of path templates where no rule fits.

Paths of a host are cut into segments. At each depth a segment stays literal if
enough of the host's different paths have it there; all others become a
wildcard, so ``/en/148.html`` and ``/en/960`` are both ``en/*``. Templates that differ
in their deepest literal only are branches of one node; branches whose labels do
not differ significantly are merged. A template is rejected when the smoothed share
of blocked paths among the labelled ones of its merged branch is high enough.

Everything is DataFrame functions. Counts are over different paths, so a URL that
is repeated a million times is one path, and a host with a third of all rows is
summed on the map side; only segment numbers and hashes travel, not whole paths.
"""

from __future__ import annotations

import functools
import string
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    """``verdict`` (allow or block) for a host, its subdomains and all paths that start with ``path``."""

    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path

    def fits(self) -> Column:
        host = F.col("host")
        return ((host == self.host) | host.endswith("." + self.host)) & F.col("path").startswith(self.path)


#: The rules of the registered query.
RULES = (
    Rule("allow", "com", "/"),
    Rule("block", "example.com", "/en/"),
    Rule("allow", "www.example.com", "/en/"),
    Rule("block", "net", "/es/"),
    Rule("block", "net", "/fr/"),
)


@dataclass(frozen=True)
class TreeSettings:
    """``min_paths`` and one in ``max_literals`` of a host's paths make a literal; ``deviations`` separate branches; the rest is the purity."""

    min_paths: int = 2
    max_literals: int = 20
    deviations: float = 2.0
    smoothing: float = 1.0
    rejected: float = 0.8


def host_and_path(url: str | Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a URL; both empty for null and where ``://`` is missing."""
    url = F.col(url) if isinstance(url, str) else url
    at = F.instr(url, "://")
    after = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    host = F.regexp_extract(after, "^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(after, F.length(host) + 1, F.length(after)), "^[^?#]*", 0)
    return F.translate(host, string.ascii_uppercase, string.ascii_lowercase), path


def _judge(rules: Sequence[Rule]) -> tuple[Column, Column]:
    """Name and verdict of the longest rule that fits."""
    longest = sorted(rules, key=lambda r: (-len(r.name), -len(r.host), r.name))
    nothing = F.lit(None).cast("string")
    name = functools.reduce(lambda rest, r: F.when(r.fits(), r.name).otherwise(rest), reversed(longest), nothing)
    verdict = functools.reduce(lambda rest, r: F.when(r.fits(), r.verdict).otherwise(rest), reversed(longest), nothing)
    return name, verdict


def path_templates(paths: DataFrame, settings: TreeSettings = TreeSettings()) -> DataFrame:
    """``(host, path_key, template, family, blocked)`` of different paths.

    ``paths`` has ``host``, ``path`` and ``blocked`` (null: not labelled), one row per
    host and path. ``family`` is the template with its deepest literal cut out.
    """
    segments = F.filter(F.split("path", "/"), lambda s: s != "")
    cells = paths.select("host", F.sha2("path", 256).alias("path_key"), "blocked", F.posexplode_outer(segments).alias("pos", "segment"))
    support = cells.where("segment is not null").groupBy("host", "pos", "segment").agg(F.count("*").alias("n"))
    whole = support.groupBy("host", "pos").agg(F.sum("n").alias("total"))
    literal = (
        support.where(F.col("n") >= settings.min_paths)
        .join(whole, ["host", "pos"])
        .where(F.col("n") * settings.max_literals >= F.col("total"))
        .select("host", "pos", "segment", F.col("segment").alias("literal"))
    )
    parts = (
        cells.join(literal, ["host", "pos", "segment"], "left")
        .groupBy("host", "path_key")
        .agg(
            F.bool_or("blocked").alias("blocked"),
            F.max(F.when(F.col("literal").isNotNull(), F.col("pos"))).alias("last"),
            F.array_sort(F.collect_list(F.when(F.col("pos").isNotNull(), F.struct("pos", "literal")))).alias("parts"),
        )
    )
    literals = F.transform("parts", lambda p: p["literal"])
    cut = F.transform("parts", lambda p: F.when(p["pos"] == F.col("last"), F.lit("{}")).otherwise(p["literal"]))
    return parts.select(
        "host", "path_key", F.array_join(literals, "/", "*").alias("template"), F.array_join(cut, "/", "*").alias("family"), "blocked"
    )


def template_tree(templates: DataFrame, settings: TreeSettings = TreeSettings()) -> DataFrame:
    """``(host, template, family, branch, paths, labelled, blocked, purity, rejected)`` of every template.

    Branches of one node are put in order of their share of blocked paths;
    neighbours that a two-proportion test cannot tell apart share their labels.
    A branch without labels says nothing about others and is not merged. A node
    has at most ``max_literals`` branches, so the windows are small whatever the host's size.
    """
    counted = templates.groupBy("host", "family", "template").agg(
        F.count("*").alias("paths"), F.count("blocked").alias("labelled"), F.count_if("blocked").alias("blocked")
    )
    known = counted.where("labelled > 0")
    in_order = Window.partitionBy("host", "family").orderBy(F.col("blocked") / F.col("labelled"), "template")
    b, n = F.col("blocked").cast("double"), F.col("labelled").cast("double")
    b0, n0 = F.lag(b).over(in_order), F.lag(n).over(in_order)
    both, all_blocked = n + n0, b + b0
    gap = (b * n0 - b0 * n) * (b * n0 - b0 * n) * both
    differs = gap > settings.deviations**2 * all_blocked * (both - all_blocked) * n * n0
    branch = F.sum("differs").over(in_order.rowsBetween(Window.unboundedPreceding, 0))
    numbered = known.withColumn("differs", F.coalesce(differs, F.lit(False)).cast("long")).withColumn("branch", branch)
    pool = Window.partitionBy("host", "family", "branch")
    s = settings.smoothing
    purity = (F.sum("blocked").over(pool) + s) / (F.sum("labelled").over(pool) + 2 * s)
    merged = numbered.withColumn("purity", purity).drop("differs")
    alone = counted.where("labelled = 0").withColumns({"branch": F.lit(None).cast("long"), "purity": F.lit(0.5)})
    return merged.unionByName(alone).withColumn("rejected", F.col("purity") >= settings.rejected)


def filter_urls(
    pages: DataFrame,
    rules: Sequence[Rule] = RULES,
    id_col: str = "page_id",
    url_col: str = "url",
    label: Column | None = None,
    settings: TreeSettings = TreeSettings(),
) -> DataFrame:
    """``(id, host, path, rule, verdict)`` of every row of ``pages``.

    The longest rule that fits decides. Where none does, the template of the path
    is blocked or allowed by the purity of its branch; labels are the verdicts of
    the rules and, where given, ``label`` (true: blocked), which several rows of a path
    join by "any blocked". A template without labels is allowed. Null, empty and
    broken URLs have an empty host and path and take part like any other. Rows
    that repeat are judged alike, other columns are ignored, an empty table gives
    an empty result. ``rules`` is a written list, checked as one expression a row.
    """
    host, path = host_and_path(url_col)
    given = F.lit(None).cast("boolean") if label is None else label
    name, verdict = _judge(rules)
    base = pages.select(F.col(id_col).alias("id"), host.alias("host"), path.alias("path"), given.alias("given"))
    base = base.withColumns({"rule": name, "by_rule": verdict})
    blocked = F.coalesce(F.col("by_rule") == "block", F.col("given"))
    paths = base.groupBy("host", "path").agg(F.bool_or(blocked).alias("blocked"))
    templates = path_templates(paths, settings)
    rejected = template_tree(templates, settings).where("rejected").select("host", "template")
    refused = templates.join(rejected, ["host", "template"], "left_semi").select("host", "path_key", F.lit(True).alias("refused"))
    open_ = base.where("rule is null").withColumn("path_key", F.sha2("path", 256)).join(refused, ["host", "path_key"], "left")
    learned = F.when(F.col("refused"), "block").otherwise("allow")
    ruled = base.where("rule is not null").select("id", "host", "path", "rule", F.col("by_rule").alias("verdict"))
    judged = open_.select("id", "host", "path", "rule", learned.alias("verdict"))
    return ruled.unionByName(judged).withColumnRenamed("id", id_col)
