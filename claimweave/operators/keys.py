"""Operators on keys: membership, duplicates, latest record, numbering."""

from __future__ import annotations

import functools
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _reduced(values: DataFrame, column: str) -> DataFrame:
    return values.select(F.col(column).alias("_member")).distinct()


def is_in(probe: DataFrame, key: Column | str, values: DataFrame, column: str) -> DataFrame:
    """Rows of ``probe`` whose key occurs in ``values`` (SQL ``IN``)."""
    key = F.col(key) if isinstance(key, str) else key
    keyed = probe.withColumn("_key", key)
    members = _reduced(values, column)
    return keyed.join(members, F.col("_key") == F.col("_member"), "left_semi").drop("_key")


def not_in(probe: DataFrame, key: Column | str, values: DataFrame, column: str) -> DataFrame:
    """Rows of ``probe`` whose key is not in ``values``, as SQL ``NOT IN``.

    A null among the values lets nothing through; a null key passes only when
    there are no values at all. Spark plans the SQL text as a nested loop once
    the value list is too big to broadcast, so this is a plain anti join plus a
    one-value subquery that tells which of the null rules applies.
    """
    key = F.col(key) if isinstance(key, str) else key
    keyed = probe.withColumn("_key", key)
    members = _reduced(values, column)
    state = values.agg(
        F.when(F.count(F.lit(1)) == 0, "empty")
        .when(F.count(F.lit(1)) > F.count(column), "has null")
        .otherwise("plain")
        .alias("state")
    ).scalar()
    return (
        keyed.join(members, F.col("_key") == F.col("_member"), "left_anti")
        .filter((state == "empty") | ((state == "plain") & F.col("_key").isNotNull()))
        .drop("_key")
    )


def duplicate_keys(df: DataFrame, key: str) -> DataFrame:
    """Key values that occur more than once, with their count; null is never a duplicate."""
    return df.groupBy(key).agg(F.count(key).alias("occurrences")).filter(F.col("occurrences") > 1)


def rows_of_duplicates(df: DataFrame, key: str) -> DataFrame:
    """Rows whose key occurs more than once."""
    return is_in(df, key, duplicate_keys(df, key), key)


def rows_of_singles(df: DataFrame, key: str) -> DataFrame:
    """Rows whose key is not null and occurs exactly once.

    One aggregate instead of a join with the counts: where the count is one,
    any row of the group is the row.
    """
    row = F.struct(*df.columns)
    return (
        df.filter(F.col(key).isNotNull())
        .groupBy(F.col(key).alias("_key"))
        .agg(F.count(F.lit(1)).alias("_rows"), F.any_value(row).alias("_row"))
        .filter(F.col("_rows") == 1)
        .select("_row.*")
    )


def latest_per_key(
    df: DataFrame, keys: Sequence[str], refreshed: Column, tie_break: Sequence[str] = ()
) -> DataFrame:
    """One row per key: the one refreshed last.

    Equal times are settled by the lowest ``tie_break`` values (nulls first)
    and then by the remaining columns, so the result does not depend on row
    order. This is an aggregate, not a window: the map side keeps one candidate
    per key and a key with very many rows never gathers in a single task.
    """
    rest = [c for c in df.columns if c not in keys]
    after = [c for c in rest if c not in tie_break]
    micros = F.unix_micros(refreshed.cast("timestamp"))
    # Lowest first: readable times before unreadable ones, late before early.
    order = F.struct(
        micros.isNull().alias("_unreadable"),
        (-micros).alias("_age"),
        *[F.col(c) for c in tie_break],
        *[F.col(c) for c in after],
    )
    best = df.groupBy(*keys).agg(F.min(order).alias("_best"))
    return best.select(*[F.col(c) if c in keys else F.col(f"_best.{c}").alias(c) for c in df.columns])


#: Names that are sampled at most to lay the buckets of a numbering.
_SAMPLED = 2048


@dataclass(frozen=True)
class Numbering:
    """Buckets of distinct names in name order, as literals: their lower bounds, and how many names come before each."""

    bounds: tuple[str, ...] = ()
    before: tuple[int, ...] = (0,)

    def bucket(self, name: Column | str) -> Column:
        """The bucket of a name; null comes first."""
        name = F.col(name) if isinstance(name, str) else name
        if not self.bounds:
            return F.lit(0)
        bounds = F.array(*[F.lit(b) for b in self.bounds])
        return F.coalesce(F.size(F.filter(bounds, lambda b: b <= name)), F.lit(0))

    def position(self, name: str, lane: Column | None = None) -> Column:
        """1, 2, 3 … over all names; rows in the same ``lane`` (by default the bucket) are numbered together."""
        bucket = self.bucket(name)
        order = Window.partitionBy(bucket if lane is None else lane).orderBy(F.col(name).asc_nulls_first())
        return F.row_number().over(order) + F.array(*[F.lit(n) for n in self.before])[bucket]


def numbering(names: DataFrame, column: str, buckets: int = 64, over: DataFrame | None = None) -> Numbering:
    """Lay buckets over the distinct values of ``column``.

    Two small queries: a sample of distinct names, the one with the smallest hash
    in each of _SAMPLED slots, so that it depends neither on the order of the rows
    nor on how often a name occurs; then one count per bucket. Only those reach
    the driver; nothing is stored. ``over`` may be a wider table that is cheaper to
    sample: a bucket then holds no more of its part than of the whole.
    """
    wide = names if over is None else over
    name, hashed = F.col(column), F.xxhash64(column)
    slots = wide.where(name.isNotNull()).groupBy(F.pmod(hashed, F.lit(_SAMPLED)).alias("slot"))
    sample = slots.agg(F.min(F.struct(hashed.alias("hash"), name.alias("name"))).alias("least")).select("least.name")
    # Ordered as Spark orders text: by its UTF-8 bytes.
    found = sorted((r[0] for r in sample.collect()), key=lambda name: name.encode())
    bounds = tuple(dict.fromkeys(found[k * len(found) // buckets] for k in range(1, buckets) if found))
    laid = Numbering(bounds)
    sizes = dict(names.select(column).distinct().groupBy(laid.bucket(column).alias("bucket")).count().collect())
    before = [0]
    for bucket in range(len(bounds)):
        before.append(before[-1] + sizes.get(bucket, 0))
    return Numbering(bounds, tuple(before))


def surrogate_keys(
    names: DataFrame, column: str, key: str, start_after: Column, laid: Numbering | None = None
) -> DataFrame:
    """Number distinct names 1, 2, 3 … in name order, continuing after ``start_after``.

    Equal to ``row_number()`` over one global ordering, without gathering all
    names in one task: each bucket of ``laid`` numbers its own names and adds how
    many come before. The plan is lazy and gives the same keys whenever it runs.
    """
    laid = laid or numbering(names, column)
    distinct = names.select(column).distinct()
    return distinct.select(column, (laid.position(column) + start_after).cast("int").alias(key))


def full_outer_using(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Full outer join on equal key columns; a null key never finds a partner."""
    return left.join(right, list(keys), "full_outer")


#: Condition of a side's rows, and its aggregates by name, each a function of the lookup of a column.
Side = tuple[Column, Mapping[str, Callable[[Callable[[str], Column]], Column]]]


def co_aggregate(rows: DataFrame, keys: Sequence[str], sides: Mapping[str, Side]) -> DataFrame:
    """Full outer join of parts of one table, as a single aggregate over one scan.

    ``sides`` gives for each part the condition of its rows and its aggregates by
    name, as functions of the column to read: ``{"paid": lambda c: F.sum(c("n"))}``.
    ``c`` shows the side's own rows only and null for the others. The result has a row for every key that any side holds; a side
    without the key shows what its aggregates give for no rows. As in the join a
    null key never finds a partner: rows with one are kept apart by side, and a
    side's rows with equal keys, null or not, are one group.

    Equal to joining the sides' groups, for any number of sides, but a key that
    holds a third of all rows is collapsed on the map side.
    """
    names = list(sides)
    member = F.array(*[F.when(F.coalesce(condition, F.lit(False)), F.lit(n)) for n, (condition, _) in sides.items()])
    values = [c for c in rows.columns if c not in keys]
    tagged = rows.withColumn("_side", F.explode(F.array_compact(member)))
    incomplete = functools.reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    tagged = tagged.withColumn("_apart", F.when(incomplete, F.col("_side")))
    # One column per side and value, so that each side's aggregates see its own rows only.
    split = [F.when(F.col("_side") == n, F.col(c)).alias(f"_{k}_{c}") for k, n in enumerate(names) for c in values]
    lanes = tagged.select(*keys, "_apart", *split)
    aggregates = []
    for k, (_, wanted) in enumerate(sides.values()):
        aggregates += [aggregate(lambda c, k=k: F.col(f"_{k}_{c}")).alias(out) for out, aggregate in wanted.items()]
    return lanes.groupBy(*keys, "_apart").agg(*aggregates).drop("_apart")


def align_key(df: DataFrame, column: str, like: DataFrame, like_column: str) -> DataFrame:
    """Give ``column`` the type it is joined to; text that is no number becomes null."""
    wanted = like.schema[like_column].dataType
    if df.schema[column].dataType == wanted:
        return df
    return df.withColumn(column, F.col(column).try_cast(wanted))
