"""Run a job: ``python -m almsbook JOB …``, or with the package zipped
``spark-submit --py-files almsbook.zip almsbook/__main__.py JOB …``.
"""

import argparse

from pyspark.sql import SparkSession

from almsbook.plans import jobs
from almsbook.schemas import RAW
from almsbook.session import tuned
from almsbook.sources.storage import scratch_scope


def _options() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="almsbook")
    job = parser.add_subparsers(dest="job", required=True)

    land = job.add_parser("land", help="copy CSV extracts into the raw layer")
    land.add_argument("--extracts", required=True, help="folder with TABLE.csv for each of: " + ", ".join(RAW))
    land.add_argument("--raw", required=True)
    land.add_argument("--tables", nargs="+", choices=list(RAW), default=[t for t in RAW if t != "adjustments"])

    load = job.add_parser("load", help="write a new version of the mart")
    load.add_argument("--raw", required=True)
    load.add_argument("--mart", required=True)
    load.add_argument("--loaded", help="mart version to build on")

    extend = job.add_parser("extend", help="add new rows to the mart as its next version")
    extend.add_argument("--raw", required=True)
    extend.add_argument("--mart", required=True)

    for name, text in (
        ("grade", "append the quality checks to the log"),
        ("expect", "check keys, references and landed types"),
        ("metrics", "write the metrics document"),
        ("statements", "write the statements per period"),
    ):
        report = job.add_parser(name, help=text)
        report.add_argument("--raw", required=True)
        report.add_argument("--mart", required=True)
        report.add_argument("--out", required=True)

    prep = job.add_parser("prep", help="clean the manual adjustments")
    prep.add_argument("--adjustments", required=True)
    prep.add_argument("--funds", required=True)
    prep.add_argument("--out", required=True)
    return parser


def run(spark: SparkSession, arguments: list[str] | None = None) -> None:
    with scratch_scope(spark):
        _run(spark, _options().parse_args(arguments))


def _run(spark: SparkSession, chosen: argparse.Namespace) -> None:
    if chosen.job == "land":
        jobs.land_raw(spark, {t: f"{chosen.extracts}/{t}.csv" for t in chosen.tables}, chosen.raw)
    elif chosen.job == "load":
        jobs.load_mart(spark, chosen.raw, chosen.mart, chosen.loaded)
    elif chosen.job == "extend":
        jobs.extend_mart(spark, chosen.raw, chosen.mart)
    elif chosen.job == "prep":
        jobs.run_prep(spark, chosen.adjustments, chosen.funds, chosen.out).show(truncate=False)
    elif chosen.job == "expect":
        jobs.check_keys(spark, chosen.raw, chosen.mart).coalesce(1).write.mode("append").parquet(chosen.out)
    else:
        books = jobs.books_of(spark, chosen.raw, chosen.mart)
        report = {"grade": jobs.log_quality, "metrics": jobs.write_metrics, "statements": jobs.write_statements}
        report[chosen.job](books, chosen.out)


if __name__ == "__main__":
    session = tuned(SparkSession.builder.appName("almsbook").getOrCreate())
    run(session)
    session.stop()
