"""Random-forest regression of the remaining life with Spark ML."""

from dataclasses import dataclass
from itertools import product

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import VectorAssembler, VectorSlicer
from pyspark.ml.regression import RandomForestRegressor
from pyspark.ml.tuning import CrossValidator
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wearlog.functions.metrics import rmse
from wearlog.operators.folds import FOLD
from wearlog.schema import LABEL, sensor_columns
from wearlog.session import shared_folder

PREDICTION = "predicted_rul"
FEATURES = "features"
VARYING = "varying_features"

# The default grid. The usual fourth axis, the least size of a node that may be
# split, has no counterpart in Spark ML.
DEFAULT_GRID = {"n_estimators": [100, 200], "max_depth": [10, 20], "min_samples_leaf": [1, 2]}

_PARAMS = {
    "n_estimators": "numTrees",
    "max_depth": "maxDepth",
    "min_samples_leaf": "minInstancesPerNode",
}


@dataclass(frozen=True)
class Search:
    """The model refitted on all rows with the best point, and the mean RMSE of every point."""

    model: PipelineModel
    best: dict
    scores: list[tuple[dict, float]]


def grid_points(grid: dict[str, list]) -> list[dict]:
    """All combinations of a grid given by its familiar parameter names."""
    unknown = set(grid) - set(_PARAMS)
    if unknown:
        raise ValueError(f"no counterpart in Spark ML for {sorted(unknown)}; use {sorted(_PARAMS)}")
    return [dict(zip(grid, values)) for values in product(*grid.values())]


def forest(
    seed: int = 42, bootstrap: bool = True, settings: dict | None = None, **point
) -> RandomForestRegressor:
    """A regressor that tries all features at every split, as is usual for regression.

    ``settings`` are Spark ML's own, e.g. ``maxBins`` or ``maxMemoryInMB`` (how many nodes are
    split in one pass over the data; raise it for deep trees).

    Node ids are cached between levels: without that, each level of a deep tree ships all
    trees grown so far to every task.
    """
    params = {
        "featuresCol": FEATURES,
        "labelCol": LABEL,
        "predictionCol": PREDICTION,
        "featureSubsetStrategy": "all",
        "cacheNodeIds": True,
        "checkpointInterval": 10,
        "seed": seed,
        "bootstrap": bootstrap,
    }
    params |= {_PARAMS[name]: value for name, value in point.items()}
    return RandomForestRegressor(**params | (settings or {}))


def _assembler(sensors: list[str]) -> VectorAssembler:
    # A missing sensor is an error here: good rows were separated from bad ones before.
    return VectorAssembler(inputCols=sensors, outputCol=FEATURES)


def _inputs(labelled: DataFrame) -> list[VectorAssembler | VectorSlicer]:
    """What puts the trees' inputs together, in the last one's output: all sensors, but for those with one
    value in all rows. No tree can be split by these, yet each pass over the rows would count them.

    All sensors are put together before, so a missing one is an error in any of them.
    """
    sensors = sensor_columns(labelled)
    assembler = _assembler(sensors)
    ends = [f(s).alias(f"{k}_{s}") for s in sensors for k, f in (("lo", F.min), ("hi", F.max))]
    found = labelled.agg(*ends).first()
    varying = [i for i, s in enumerate(sensors) if found[f"lo_{s}"] != found[f"hi_{s}"]]
    if not varying or len(varying) == len(sensors):
        return [assembler]
    return [assembler, VectorSlicer(inputCol=FEATURES, outputCol=VARYING, indices=varying)]


def fit_forest(
    train: DataFrame,
    seed: int = 42,
    bootstrap: bool = True,
    settings: dict | None = None,
    **point,
) -> PipelineModel:
    """Train one forest on the labelled rows."""
    shared_folder(train.sparkSession)
    stages = [_assembler(sensor_columns(train)), forest(seed, bootstrap, settings, **point)]
    return Pipeline(stages=stages).fit(train.filter(F.col(LABEL).isNotNull()))


def search_forest(
    folded: DataFrame,
    folds: int,
    grid: dict[str, list] | None = None,
    seed: int = 42,
    bootstrap: bool = True,
    parallelism: int = 2,
    settings: dict | None = None,
) -> Search:
    """Cross-validate every grid point over column ``fold`` (0 to ``folds`` - 1), then fit the
    best one on all rows."""
    shared_folder(folded.sparkSession)
    points = grid_points(DEFAULT_GRID if grid is None else grid)
    labelled = folded.filter(F.col(LABEL).isNotNull())
    inputs = _inputs(labelled)
    features = inputs[-1].getOutputCol()
    vectors = PipelineModel(inputs).transform(labelled).select(features, LABEL, FOLD)
    estimator = forest(seed, bootstrap, {"featuresCol": features} | (settings or {}))
    maps = [
        {estimator.getParam(_PARAMS[name]): value for name, value in point.items()}
        for point in points
    ]
    search = CrossValidator(
        estimator=estimator,
        estimatorParamMaps=maps,
        evaluator=RegressionEvaluator(
            labelCol=LABEL, predictionCol=PREDICTION, metricName="rmse"
        ),
        numFolds=folds,
        foldCol=FOLD,
        parallelism=parallelism,
    ).fit(vectors)
    scores = [(point, float(error)) for point, error in zip(points, search.avgMetrics)]
    best = min(scores, key=lambda scored: scored[1])[0]
    return Search(PipelineModel([*inputs, search.bestModel]), best, scores)


def score(model: PipelineModel, df: DataFrame) -> DataFrame:
    """The table with ``predicted_rul``; batch or stream."""
    return model.transform(df).drop(FEATURES, VARYING)


def score_record(spark: SparkSession, model: PipelineModel, record: dict[str, float]) -> float:
    """The prediction for one set of readings."""
    readings = {name: float(value) for name, value in record.items()}
    return score(model, spark.createDataFrame([readings])).first()[PREDICTION]


def model_rmse(model: PipelineModel, df: DataFrame) -> DataFrame:
    """One row ``rmse``: the model's error on the labelled rows."""
    return score(model, df).agg(rmse(F.col(LABEL), F.col(PREDICTION)).alias("rmse"))


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
