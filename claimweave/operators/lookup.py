"""Attaching provider systems to facts that are already reduced per tax ID."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimweave.operators.keys import align_key


def attach_providers(
    reduced: DataFrame, tin: str, lookup: DataFrame, names: dict[str, str], sums: Iterable[str]
) -> DataFrame:
    """Join the lookup on ``tin`` and take over its columns ``names`` (lookup name: new name).

    A tax ID of several providers counts for each, and one listed several times
    for a provider counts as often. In the latter case the ``sums`` are
    multiplied instead of the rows, however often it is listed.
    """
    columns = [F.col(old).alias(new) for old, new in names.items()]
    providers = lookup.groupBy(F.col("tin").alias("_lookup_tin"), *columns).agg(
        F.count(F.lit(1)).cast("int").alias("_times")
    )
    reduced = align_key(reduced, tin, lookup, "tin")
    joined = reduced.join(providers, F.col(tin) == F.col("_lookup_tin"))
    return joined.withColumns({c: F.col(c) * F.col("_times") for c in sums}).drop("_lookup_tin", "_times", tin)
