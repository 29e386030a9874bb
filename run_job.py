"""Runs one job from the command line, for instance through spark-submit.

    spark-submit run_job.py claims_documents_job --claims warehouse.claims \\
        --lookup parquet:/data/providers --level tin --period month --path /published/tin_month

Tables are named as in the catalog or given as ``format:path``. Options of a document
store are read from a file, as command lines are visible to others. ``run_job.py JOB
--help`` lists the arguments of a job. Spark settings belong to spark-submit.
"""

from __future__ import annotations

import argparse
import datetime as dt
import inspect
import json
import sys

from claimweave.plans import jobs
from claimweave.session import build_session
from claimweave.sources import read_files, read_table

JOBS = {name: job for name, job in vars(jobs).items() if name.endswith("_job")}


def _input(spark, text: str):
    file_format, colon, path = text.partition(":")
    if not colon:
        return read_table(spark, text)
    options = {"header": "true"} if file_format == "csv" else {}
    return read_files(spark, path, file_format, **options)


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    commands = parser.add_subparsers(dest="job", required=True)
    for name, job in JOBS.items():
        command = commands.add_parser(name, help=inspect.getdoc(job).splitlines()[0])
        for parameter in inspect.signature(job).parameters.values():
            if parameter.name == "store":
                command.add_argument("--store-format")
                command.add_argument("--store-options", metavar="FILE", help="JSON object, credentials included")
            elif parameter.name != "spark":
                required = parameter.default is parameter.empty
                command.add_argument(
                    "--" + parameter.name.replace("_", "-"),
                    required=required,
                    default=None if required else parameter.default,
                    type=int if parameter.annotation == "int" else str,
                )
    return parser


def main(argv: list[str]) -> None:
    given = vars(_parser().parse_args(argv))
    job = JOBS[given["job"]]
    spark = build_session(given["job"])
    arguments = {}
    for parameter in inspect.signature(job).parameters.values():
        if parameter.name == "spark":
            value = spark
        elif parameter.name == "store":
            options = {}
            if given["store_options"]:
                with open(given["store_options"], encoding="utf-8") as text:
                    options = json.load(text)
            value = jobs.DocumentStore(given["store_format"], options) if given["store_format"] else None
        else:
            value = given[parameter.name]
            if parameter.annotation == "DataFrame":
                value = _input(spark, value)
            elif parameter.annotation == "dt.datetime":
                value = dt.datetime.fromisoformat(value)
        arguments[parameter.name] = value
    job(**arguments)


if __name__ == "__main__":
    main(sys.argv[1:])
