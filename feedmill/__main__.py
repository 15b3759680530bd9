"""The jobs, for ``spark-submit`` or ``python -m feedmill``.

    feed loan --csv FILE --fmt kafka --option topic=loans --option kafka.bootstrap.servers=...
    ingest loan --base DIR --topic loans --option kafka.bootstrap.servers=...
    compact loan --base DIR
    train loan --base DIR --result-model forest
    marts --base DIR --target parquet=DIR/marts --target mongodb --target-option mongodb.collection={mart}
    charts --base DIR/marts --out DIR/charts
    charts --fmt mongodb --option collection={mart} --out DIR/charts

``{mart}`` stands for the mart's name. With ``--together`` marts and charts use folders whose
marts change at once.

Names are ``loan`` and ``mkt``. Tables lie under the base folder as
``<name>_bronze``, ``<name>_silver``, ``<name>_gold`` and their results.
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from feedmill import fixed_values as fixed
from feedmill.plans import feed, loan, marketing, marts, report
from feedmill.session import build_session
from feedmill.sources.releases import Place, read_published
from feedmill.sources.scratch import release
from feedmill.sources.tables import Target, publish, read_csv, read_table
from feedmill.streaming.ingest import compact, file_stream, start_ingest, topic_stream
from feedmill.streaming.progress import ProgressLog, run_until_marked

# For the events of a stream's end to come in.
LAST_EVENT_SECONDS = 10
PLANS = {"loan": loan, "mkt": marketing}
CHART_MARTS = [
    "viz_loan_grade", "viz_mkt_balance", "viz_loan_home", "viz_mkt_edu", "viz_loan_scatter", "viz_mkt_job",
]


def arguments(words: list[str] | None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="feedmill", description=__doc__, formatter_class=argparse.RawTextHelpFormatter)
    jobs = parser.add_subparsers(dest="job", required=True)
    job = {name: jobs.add_parser(name) for name in ("feed", "ingest", "compact", "train", "marts", "charts")}
    for name in ("feed", "ingest", "compact", "train"):
        job[name].add_argument("name", choices=sorted(PLANS))
    for name in ("ingest", "compact", "train", "marts"):
        job[name].add_argument("--base", required=True)
    for name in ("feed", "ingest", "charts"):
        job[name].add_argument("--option", action="append", default=[], help="key=value for the reader or writer")
    job["feed"].add_argument("--csv", required=True)
    job["feed"].add_argument("--order-by", action="append", help="default: the order of the file")
    job["feed"].add_argument("--rows", type=int, help="the first so many; default: all")
    job["feed"].add_argument("--fmt", default="kafka")
    job["feed"].add_argument("--path")
    job["ingest"].add_argument("--topic")
    job["ingest"].add_argument("--files", help="folder of text files in place of a topic")
    job["ingest"].add_argument("--once", action="store_true", help="take what is there and end")
    job["ingest"].add_argument("--progress", action="store_true", help="write a row per trigger beside the bronze table")
    job["ingest"].add_argument("--stop-marker", help="end once this file is there")
    job["feed"].add_argument("--partitions", type=int, help="of the topic, to deal out chunks in order")
    job["compact"].add_argument("--keep", type=int, default=2, help="batches at the end that stay as they are")
    for name in ("ingest", "compact", "train", "marts"):
        job[name].add_argument("--table-fmt", default="parquet")
    job["train"].add_argument("--fit-all", action="store_true", help="fit weight, indexes and scale on the holdout too")
    job["train"].add_argument("--result-model", choices=["logistic", "forest"], help="loans only")
    job["train"].add_argument("--max-bins", type=int, help="for categories with more than 32 values")
    job["train"].add_argument("--partitions", type=int, help="of the training rows; needed on a cluster")
    job["train"].add_argument("--schema-from-first-row", action="store_true", help="contacts only")
    job["marts"].add_argument("--target", action="append", required=True, help="format=folder, or format alone")
    job["marts"].add_argument("--target-option", action="append", default=[], help="format.key=value")
    job["marts"].add_argument("--scatter-rows", type=int, help="default: all")
    job["marts"].add_argument("--together", action="store_true", help="all targets show all marts at once, or none; folders only")
    job["charts"].add_argument("--together", action="store_true", help="the base holds marts that were published together")
    job["charts"].add_argument("--base", help="folder of the marts")
    job["charts"].add_argument("--fmt", default="parquet")
    job["charts"].add_argument("--out", required=True)
    return parser.parse_args(words)


def run_feed(spark: SparkSession, given: argparse.Namespace, options: dict[str, str]) -> None:
    publish(feed.encode_feed(read_csv(spark, given.csv), given.order_by, given.rows), given.fmt, given.path, given.partitions, **options)


def run_ingest(spark: SparkSession, given: argparse.Namespace, options: dict[str, str]) -> None:
    source = file_stream(spark, given.files, **options) if given.files else topic_stream(spark, given.topic, **options)
    bronze, ledger, checkpoint = [f"{given.base}/{given.name}_{part}" for part in ("bronze", "ledger", "checkpoint")]
    trigger = None if given.once else fixed.INGEST_TRIGGER
    log = ProgressLog(spark, f"{given.base}/{given.name}_progress") if given.progress else None
    if log:
        spark.streams.addListener(log)
    query = start_ingest(source, bronze, ledger, checkpoint, given.table_fmt, trigger)
    try:
        if given.stop_marker:
            run_until_marked(query, spark, given.stop_marker)
        else:
            query.awaitTermination()
    finally:
        if log:
            log.ended.wait(LAST_EVENT_SECONDS)
            spark.streams.removeListener(log)
            log.write()


def training_options(given: argparse.Namespace) -> dict:
    """What was given of the options of a plan's ``run``."""
    named = {"result_model": given.result_model, "maxBins": given.max_bins, "partitions": given.partitions}
    options = {name: value for name, value in named.items() if value is not None}
    if given.schema_from_first_row:
        options["schema_from_first_row"] = True
    return {"fit_all": given.fit_all, **options}


def mart_targets(given: argparse.Namespace, mart: str) -> list[Target]:
    """The places of one mart: below a folder, or where the format's options say."""
    options: dict[str, dict[str, str]] = {}
    for pair in given.target_option:
        name, value = pair.split("=", 1)
        fmt, key = name.split(".", 1)
        options.setdefault(fmt, {})[key] = value.replace("{mart}", mart)
    pairs = [target.partition("=") for target in given.target]
    return [Target(fmt, f"{folder}/{mart}" if folder else None, options.get(fmt, {})) for fmt, _, folder in pairs]


def mart_places(given: argparse.Namespace) -> list[Place]:
    """The folders of marts that change together."""
    folders = [target.partition("=")[2] for target in given.target]
    if not all(folders):
        raise ValueError("--together needs a folder for every target")
    return [Place(folder, target.fmt, target.options) for folder, target in zip(folders, mart_targets(given, ""))]


def run_marts(spark: SparkSession, given: argparse.Namespace) -> None:
    if given.together:
        marts.run_together(spark, given.base, mart_places(given), given.table_fmt, given.scatter_rows)
    else:
        marts.run(spark, given.base, lambda name: mart_targets(given, name), given.table_fmt, given.scatter_rows)


def run_charts(spark: SparkSession, given: argparse.Namespace, options: dict[str, str]) -> None:
    built = {}
    for mart in CHART_MARTS:
        own = {key: value.replace("{mart}", mart) for key, value in options.items()}
        if given.together:
            built[mart] = read_published(spark, Place(given.base, given.fmt, own), mart)
        else:
            built[mart] = read_table(spark, f"{given.base}/{mart}" if given.base else None, given.fmt, **own)
    report.chart_rows(built).write.mode("overwrite").partitionBy("chart").json(given.out)


def main(words: list[str] | None = None) -> None:
    given = arguments(words)
    spark = build_session(f"feedmill-{given.job}")
    options = dict(pair.split("=", 1) for pair in getattr(given, "option", []))
    if given.job == "feed":
        run_feed(spark, given, options)
    elif given.job == "ingest":
        run_ingest(spark, given, options)
    elif given.job == "compact":
        compact(spark, f"{given.base}/{given.name}_bronze", f"{given.base}/{given.name}_ledger", given.table_fmt, given.keep)
    elif given.job == "train":
        PLANS[given.name].run(spark, given.base, given.table_fmt, **training_options(given)).report.show(truncate=False)
    elif given.job == "marts":
        run_marts(spark, given)
    else:
        run_charts(spark, given, options)


def command() -> None:
    """One job as its own application; what it staged is deleted at its end."""
    try:
        main()
    finally:
        if (spark := SparkSession.getActiveSession()) is not None:
            release(spark)


if __name__ == "__main__":
    command()
