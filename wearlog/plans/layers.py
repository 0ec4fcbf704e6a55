"""Landing text -> bronze -> silver -> gold, one Parquet directory per layer and split.

    bronze   train, test   typed log        RUL    labels as landed
             truth         labels by engine rejects/{train,test,truth}
    silver   train, test   labelled, standardised log        stats   what they were scaled by
    gold     train, test   model inputs and label
"""

from collections.abc import Callable
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

from wearlog.operators.attach import BROADCAST_BYTES
from wearlog.operators.features import gold_projection
from wearlog.operators.labels import label_from_truth, label_run_to_failure
from wearlog.operators.scaling import apply_stats, fit_stats
from wearlog.schema import LABEL
from wearlog.session import scratch
from wearlog.sources.landing import (
    good_rows,
    land_log,
    number_lines,
    parse_truth,
    rejected_lines,
    rejected_truth,
)
from wearlog.sources.tables import folders, overwrite_table, preview, read_table

LOG_SPLITS = ("train", "test")


def _together(spark: SparkSession, *steps: Callable) -> list:
    """Run independent steps at the same time, so one's last tasks leave no cores idle."""
    with ThreadPool(len(steps)) as pool:
        return pool.map(inheritable_thread_target(spark)(lambda step: step()), steps)


def land(
    spark: SparkSession,
    landing: str,
    bronze: str,
    dataset: str = "FD001",
    skip_header: bool = True,
    parts: tuple[str, ...] = (*LOG_SPLITS, LABEL),
) -> None:
    """Landing files ``train_<dataset>.txt``, ``test_<dataset>.txt``, ``RUL_<dataset>.txt`` as typed
    tables. Each may also be a directory of files. ``parts``: which of them."""

    def log(split: str) -> None:
        parsed = land_log(spark, f"{landing}/{split}_{dataset}.txt", skip_header)
        overwrite_table(good_rows(parsed), f"{bronze}/{split}")
        overwrite_table(rejected_lines(parsed), f"{bronze}/rejects/{split}")

    def truth() -> None:
        numbered = number_lines(spark, f"{landing}/{LABEL}_{dataset}.txt", skip_header)
        overwrite_table(parse_truth(numbered), f"{bronze}/truth")
        overwrite_table(read_table(spark, f"{bronze}/truth").select(LABEL), f"{bronze}/{LABEL}")
        overwrite_table(rejected_truth(numbered), f"{bronze}/rejects/truth")

    steps = [truth if part == LABEL else lambda part=part: log(part) for part in parts]
    with scratch(spark):
        _together(spark, *steps)


def refine(
    spark: SparkSession, bronze: str, silver: str, broadcast_bytes: int = BROADCAST_BYTES
) -> None:
    """Bronze tables labelled, with sensors standardised by the training data."""
    train, test, truth = (read_table(spark, f"{bronze}/{name}") for name in (*LOG_SPLITS, "truth"))
    limits = {"broadcast_bytes": broadcast_bytes}
    with scratch(spark):
        _, *labelled = _together(
            spark,
            lambda: overwrite_table(fit_stats(train), f"{silver}/stats"),
            lambda: label_run_to_failure(train, **limits),
            lambda: label_from_truth(test, truth, **limits),
        )
        stats = read_table(spark, f"{silver}/stats")
        scaled = [apply_stats(rows, stats) for rows in labelled]
        _together(
            spark,
            lambda: overwrite_table(scaled[0], f"{silver}/train"),
            lambda: overwrite_table(scaled[1], f"{silver}/test"),
        )


def project(spark: SparkSession, silver: str, gold: str, keep_keys: bool = False) -> None:
    """Silver tables cut down to what the model takes; ``keep_keys`` keeps engine and cycle."""

    def cut(split: str) -> None:
        rows = read_table(spark, f"{silver}/{split}")
        overwrite_table(gold_projection(rows, keep_keys), f"{gold}/{split}")

    _together(spark, *[lambda split=split: cut(split) for split in LOG_SPLITS])


def previews(spark: SparkSession, gold: str, n: int = 5) -> dict[str, DataFrame]:
    """The first rows of every table below ``gold``, by name."""
    return {name: preview(read_table(spark, f"{gold}/{name}"), n) for name in folders(spark, gold)}


def run_batch(
    spark: SparkSession,
    landing: str,
    out: str,
    dataset: str = "FD001",
    skip_header: bool = True,
    keep_keys: bool = False,
) -> dict[str, DataFrame]:
    """Run all three stages below ``out``; returns the first rows of each gold table."""
    bronze, silver, gold = (f"{out}/{layer}" for layer in ("bronze", "silver", "gold"))
    land(spark, landing, bronze, dataset, skip_header)
    refine(spark, bronze, silver)
    project(spark, silver, gold, keep_keys)
    return previews(spark, gold)
