"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR is the table folder, BENCH_CPUS the number of local threads,
BENCH_QUERIES an optional comma-separated choice of registered queries. Each
query is planned and run twice in full and the faster run counts: the first one
also pays for compiling its generated code.
"""

from __future__ import annotations

import glob
import json
import os
import tempfile
import time

from claimweave.plans.registry import queries
from claimweave.session import build_session

HEADLINE = [
    "claims_system_year",
    "claims_system_month",
    "claims_tin_year",
    "claims_tin_month",
    "claims_denials_system_year",
    "claims_denials_tin_month",
    "claims_documents_system_year",
    "claims_documents_system_month",
    "claims_documents_tin_year",
    "claims_documents_tin_month",
    "calls_by_lob",
    "calls_by_question",
    "selfservice_monthly",
    "selfservice_final",
    "pcor_extract",
    "provider_tin_list",
    "provider_history_load",
    "key_list_refresh",
    "reconcile_rejected",
    "reconcile_merged",
    "latest_per_key",
    "format_tin",
]

RUNS = 2


def spread(spark, sf_dir: str, files: int, to: str) -> str:
    """A copy of the tables in ``files`` files each, as tables of a cluster come in many.

    The given ones have a single row group, which one task has to read alone whatever the query does. The copy is not timed;
    rows and queries are the same. ``BENCH_FILES=1`` times the tables as they are.
    """
    for path in sorted(glob.glob(os.path.join(sf_dir, "*.parquet"))):
        spark.read.parquet(path).repartition(files).write.parquet(os.path.join(to, os.path.basename(path)))
    return to


def run(spark, query, sf_dir: str) -> float:
    start = time.perf_counter()
    query(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    chosen = os.environ.get("BENCH_QUERIES")
    names = chosen.split(",") if chosen else HEADLINE
    spark = build_session(
        "bench",
        master=f"local[{cpus}]",
        initial_partitions=int(cpus),
        settings={
            "spark.driver.memory": "16g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            # Do not record the Python line of every column expression.
            "spark.python.sql.dataFrameDebugging.enabled": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    registered = queries()
    files = int(os.environ.get("BENCH_FILES", cpus))
    with tempfile.TemporaryDirectory() as to:
        read = spread(spark, sf_dir, files, to) if files > 1 else sf_dir
        run(spark, registered["claims_system_year"], read)  # start-up is not measured
        seconds = {name: round(min(run(spark, registered[name], read) for _ in range(RUNS)), 3) for name in names}
        spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "cpus": int(cpus),
                "runs": RUNS,
                "files_per_table": files,
            }
        )
    )


if __name__ == "__main__":
    main()
