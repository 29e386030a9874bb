"""Session set-up for jobs, tests and the benchmark."""

from __future__ import annotations

from pyspark.sql import SparkSession

_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Warehouse tables written by other tools store text as plain binary.
    "spark.sql.parquet.binaryAsString": "true",
    # Compiled stages that a driver or executor keeps. A load has several hundred, and with Spark's 100 each of
    # its outputs would compile them anew, on every executor.
    "spark.sql.codegen.cache.maxEntries": "1000",
}


def build_session(
    app_name: str,
    master: str | None = None,
    initial_partitions: int | None = None,
    settings: dict[str, str] | None = None,
) -> SparkSession:
    """Return a session with adaptive execution on and the time zone pinned.

    ``initial_partitions`` is the shuffle width before adaptive coalescing. On
    a large cluster set it high (thousands) and let Spark merge the small ones;
    leave it out to keep whatever spark-submit configured. ANSI mode is left at
    Spark's default; the expressions in this package are safe under both modes.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in _SETTINGS.items():
        builder = builder.config(key, value)
    if initial_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(initial_partitions))
    for key, value in (settings or {}).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
