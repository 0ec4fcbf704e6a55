"""Command line: ``spark-submit ... wearlog/__main__.py`` or ``python -m wearlog``.

Spark's own settings (master, memory, ``spark.checkpoint.dir``) come from the session.
"""

import argparse
from collections.abc import Sequence

from pyspark.sql import SparkSession

from wearlog.operators.forest import load_model
from wearlog.plans.layers import run_batch
from wearlog.plans.trainer import grow_life, train_life
from wearlog.sources.tables import read_table
from wearlog.streaming import jobs
from wearlog.streaming.events import ALERT_THRESHOLD, read_events


def _arguments(args: Sequence[str] | None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="wearlog", description=__doc__)
    commands = parser.add_subparsers(dest="command", required=True)

    batch = commands.add_parser("batch", help="landing text to bronze, silver and gold tables")
    batch.add_argument("landing")
    batch.add_argument("out")
    batch.add_argument("--dataset", default="FD001")
    batch.add_argument("--no-header", action="store_true", help="files begin with a record")
    batch.add_argument("--keep-keys", action="store_true", help="keep engine and cycle in gold")

    train = commands.add_parser("train", help="grid search over gold/train, save the best model")
    train.add_argument("gold")
    train.add_argument("model")
    train.add_argument("--folds", type=int, default=3)
    train.add_argument("--by-engine", action="store_true", help="never cut an engine in two")
    train.add_argument("--parallelism", type=int, default=2)
    train.add_argument(
        "--grid",
        action="append",
        default=[],
        metavar="NAME=VALUES",
        help="values of a parameter, e.g. max_depth=5,10; the default grid if none is given",
    )
    train.add_argument(
        "--setting",
        action="append",
        default=[],
        metavar="NAME=VALUE",
        help="a parameter of Spark's forest, e.g. maxBins=64 or maxMemoryInMB=1024",
    )

    train.add_argument(
        "--grown",
        action="store_true",
        help="grow the forests level by level; the grid may then hold min_samples_split too",
    )

    def streaming(name: str, text: str) -> argparse.ArgumentParser:
        command = commands.add_parser(name, help=text)
        command.add_argument("source")
        command.add_argument("table")
        command.add_argument("checkpoint")
        command.add_argument("--once", action="store_true", help="stop after the data at hand")
        return command

    ingest = streaming("ingest", "events to a table of complete and rejected ones")
    ingest.add_argument("--format", default="text", help="streaming source, e.g. kafka")
    ingest.add_argument("--body", default="value", help="the source's column with the JSON")
    ingest.add_argument("--option", action="append", default=[], metavar="KEY=VALUE")
    score = streaming("score", "complete events to predictions")
    score.add_argument("--model", required=True)
    score.add_argument("--stats", help="silver/stats, if the events are raw readings")
    alert = streaming("alert", "low predictions to alerts")
    alert.add_argument("--threshold", type=float, default=ALERT_THRESHOLD)
    return parser.parse_args(args)


def _pairs(options: Sequence[str]) -> list[list[str]]:
    return [option.split("=", 1) for option in options]


def main(args: Sequence[str] | None = None) -> None:
    given = _arguments(args)
    spark = SparkSession.builder.appName(f"wearlog-{given.command}").getOrCreate()
    if given.command == "batch":
        first = run_batch(
            spark, given.landing, given.out, given.dataset, not given.no_header, given.keep_keys
        )
        for split, rows in first.items():
            print(f"gold/{split}")
            rows.show(truncate=False)
        return
    if given.command == "train":
        grid = {name: [int(v) for v in values.split(",")] for name, values in _pairs(given.grid)}
        if given.grown:
            grown = grow_life(spark, given.gold, given.folds, grid or None, given.by_engine)
            grown.save(given.model)
            print("best point", grown.best)
            print("RMSE train", grown.rmse(), "test", grown.rmse(grown.test))
            return
        found = train_life(
            spark,
            given.gold,
            given.folds,
            grid or None,
            given.by_engine,
            parallelism=given.parallelism,
            settings={name: int(value) for name, value in _pairs(given.setting)},
        )
        found.save(given.model)
        print("best point", found.search.best)
        print("RMSE train", found.rmse(), "test", found.rmse(found.test))
        return

    trigger = {"available_now": True} if given.once else {}
    where = (given.table, given.checkpoint)
    if given.command == "ingest":
        options = dict(_pairs(given.option))
        path = given.source if given.source != "-" else None
        events = read_events(spark, path, given.format, given.body, **options)
        query = jobs.ingest(events, *where, **trigger)
    elif given.command == "score":
        stats = read_table(spark, given.stats) if given.stats else None
        model = load_model(given.model)
        query = jobs.score_stream(spark, model, given.source, *where, stats=stats, **trigger)
    else:
        query = jobs.alert_stream(
            spark, given.source, *where, threshold=given.threshold, **trigger
        )
    query.awaitTermination()


if __name__ == "__main__":
    main()
