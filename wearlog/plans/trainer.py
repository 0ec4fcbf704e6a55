"""Training run over gold tables."""

from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wearlog.functions.metrics import rmse
from wearlog.operators import forest, trees
from wearlog.operators.compiled import Compiled, compile_forest, score_compiled
from wearlog.operators.features import with_label
from wearlog.operators.folds import assign_folds, read_with_folds
from wearlog.schema import KEYS, LABEL
from wearlog.session import scratch
from wearlog.sources.tables import preview, read_table


@dataclass(frozen=True)
class LifeModel:
    """What a search over gold tables found, with the tables it is about."""

    search: forest.Search
    train: DataFrame
    test: DataFrame

    @property
    def model(self) -> PipelineModel:
        return self.search.model

    def predict(self) -> DataFrame:
        """The test rows with ``predicted_rul``."""
        return forest.score(self.model, self.test)

    def rmse(self, rows: DataFrame | None = None) -> float:
        """The error on the labelled ones of these rows, by default the training rows."""
        return forest.model_rmse(self.model, self.train if rows is None else rows).first()["rmse"]

    def save(self, path: str) -> None:
        forest.save_model(self.model, path)

    def first_predictions(self, n: int = 100) -> DataFrame:
        """The first predictions, by engine and cycle where the table kept its keys."""
        predicted = self.predict()
        return preview(predicted, n, [key for key in KEYS if key in predicted.columns])


def _folded(spark: SparkSession, path: str, cv: int, by_engine: bool) -> DataFrame:
    rows = read_table(spark, path)
    if by_engine:
        return assign_folds(rows, cv, ["engine_id"], by_rows=False)
    if set(KEYS) <= set(rows.columns):
        return assign_folds(rows, cv, KEYS)
    return read_with_folds(spark, path, cv)


def train_life(
    spark: SparkSession,
    gold: str,
    cv: int = 3,
    grid: dict[str, list] | None = None,
    by_engine: bool = False,
    seed: int = 42,
    parallelism: int = 2,
    settings: dict | None = None,
) -> LifeModel:
    """Grid search over ``cv`` contiguous folds of ``gold/train``, then a fit on all rows with the best
    point.

    Rows are taken by engine and cycle where the table kept its keys, else as stored. ``by_engine`` never
    cuts an engine in two, so close cycles cannot leak between folds. ``settings`` are Spark ML's own.
    """
    with scratch(spark):
        folded = _folded(spark, f"{gold}/train", cv, by_engine)
        search = forest.search_forest(
            folded, cv, grid, seed, parallelism=parallelism, settings=settings
        )
    test = with_label(read_table(spark, f"{gold}/test"))
    return LifeModel(search, read_table(spark, f"{gold}/train"), test)


@dataclass(frozen=True)
class GrownLife:
    """What a search with all four limits found, with the tables it is about."""

    compiled: Compiled
    best: dict
    scores: list[tuple[dict, float]]
    train: DataFrame
    test: DataFrame

    def predict(self, rows: DataFrame | None = None) -> DataFrame:
        """These rows, by default the test rows, with ``predicted_rul``."""
        return score_compiled(self.compiled, self.test if rows is None else rows)

    def rmse(self, rows: DataFrame | None = None) -> float:
        """The error on the labelled ones of these rows, by default the training rows."""
        scored = self.predict(self.train if rows is None else rows)
        return scored.agg(rmse(F.col(LABEL), F.col(forest.PREDICTION)).alias("rmse")).first()["rmse"]

    def save(self, path: str) -> None:
        self.compiled.save(self.train.sparkSession, path)


def grow_life(
    spark: SparkSession,
    gold: str,
    cv: int = 3,
    grid: dict[str, list] | None = None,
    by_engine: bool = False,
    seed: int = 42,
    bootstrap: bool = True,
) -> GrownLife:
    """``train_life`` with the forests of ``operators.trees``: the grid may limit the least size of a node that
    is split, and all its points grow in the same passes over the data."""
    with scratch(spark):
        folded = _folded(spark, f"{gold}/train", cv, by_engine)
        found = trees.grid_search(folded, cv, grid, bootstrap=bootstrap, seed=seed)
    test = with_label(read_table(spark, f"{gold}/test"))
    train = read_table(spark, f"{gold}/train")
    return GrownLife(compile_forest(found.forest), found.best, found.scores, train, test)
