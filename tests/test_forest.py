"""Training, search, scoring, persistence."""

import random

import pytest
from pyspark.sql import functions as F

from wearlog.operators import forest
from wearlog.operators.compiled import compile_model, score_compiled
from wearlog.plans.trainer import train_life
from wearlog.schema import KEYS, LABEL, SENSORS


@pytest.fixture(scope="module")
def gold(spark, tmp_path_factory):
    """Life depends on two sensors; 10 engines of 30 cycles."""
    folder = tmp_path_factory.mktemp("gold")
    rng = random.Random(1)
    rows = []
    for engine in range(1, 11):
        for cycle in range(30):
            x = {s: rng.uniform(-1, 1) for s in SENSORS}
            life = int(100 + 40 * x["sensor_2"] + (30 if x["sensor_3"] > 0 else 0))
            rows.append((engine, cycle, *x.values(), life))
    schema = ", ".join(
        [*[f"{k} int" for k in KEYS], *[f"{s} double" for s in SENSORS], f"{LABEL} int"]
    )
    df = spark.createDataFrame(rows, schema)
    df.write.parquet(f"{folder}/keyed/train")
    df.drop(*KEYS).write.parquet(f"{folder}/train")
    for test in (f"{folder}/test", f"{folder}/keyed/test"):
        df.drop(*KEYS, LABEL).limit(40).write.parquet(test)
    return folder


@pytest.fixture(scope="module")
def life(spark, gold):
    grid = {"n_estimators": [5], "max_depth": [1, 6], "min_samples_leaf": [1]}
    return train_life(spark, str(gold), cv=3, grid=grid)


@pytest.fixture()
def record(spark, gold):
    """The readings of one training row."""
    row = spark.read.parquet(f"{gold}/keyed/train").filter("engine_id = 3 AND cycle = 4").first()
    return {s: row[s] for s in SENSORS}


def test_search_picks_the_deeper_forest(life):
    scores = {point["max_depth"]: error for point, error in life.search.scores}
    assert scores[6] < scores[1]
    assert life.search.best == {"n_estimators": 5, "max_depth": 6, "min_samples_leaf": 1}
    assert life.rmse() < scores[6] < 25


def test_predictions(life):
    predicted = life.predict()
    assert predicted.columns == [*SENSORS, LABEL, forest.PREDICTION]
    assert predicted.count() == 40
    # Test rows without labels get empty ones, so they have no error either.
    assert {r[LABEL] for r in predicted.collect()} == {None}
    assert life.rmse(life.test) is None
    assert life.first_predictions(7).count() == 7


def test_save_and_score_one_record(spark, life, record, tmp_path):
    path = str(tmp_path / "deep" / "model")
    life.save(path)
    life.save(path)
    once = forest.score_record(spark, life.model, record)
    again = forest.score_record(spark, forest.load_model(path), record)
    assert once == again and 30 < once < 180


@pytest.mark.parametrize("by_engine", [False, True])
def test_folds_by_key(spark, gold, by_engine):
    grid = {"n_estimators": [2], "max_depth": [3]}
    life = train_life(spark, f"{gold}/keyed", cv=2, grid=grid, by_engine=by_engine)
    assert len(life.search.scores) == 1


def test_seed_makes_training_repeatable(spark, gold):
    train = spark.read.parquet(f"{gold}/train")
    errors = {
        forest.model_rmse(forest.fit_forest(train, n_estimators=3, max_depth=4), train).first()[0]
        for _ in range(2)
    }
    assert len(errors) == 1


@pytest.fixture(scope="module")
def flat(spark, gold):
    """A search where two sensors never change, and the rows."""
    rows = spark.read.parquet(f"{gold}/keyed/train").withColumns(
        {"sensor_1": F.lit(518.67), "sensor_9": F.lit(0.0), "fold": F.col("engine_id") % 2}
    )
    grid = {"n_estimators": [3], "max_depth": [2, 4]}
    return forest.search_forest(rows, 2, grid), rows


def test_sensors_that_never_change_are_not_searched(spark, flat, tmp_path):
    found, rows = flat
    trees = found.model.stages[-1]
    assert trees.numFeatures == len(SENSORS) - 2
    scored = forest.score(found.model, rows)
    assert scored.columns == [*rows.columns, forest.PREDICTION]
    # The same forest as over all sensors, and as compiled.
    best = {name: value for name, value in found.best.items()}
    whole = forest.fit_forest(rows.select(*SENSORS, LABEL), **best)
    assert whole.stages[-1].numFeatures == len(SENSORS)
    ours = score_compiled(compile_model(spark, found.model), rows).withColumnRenamed(forest.PREDICTION, "compiled")
    both = forest.score(whole, forest.score(found.model, ours).withColumnRenamed(forest.PREDICTION, "sliced"))
    off = F.greatest(F.abs(F.col(forest.PREDICTION) - F.col("sliced")), F.abs(F.col(forest.PREDICTION) - F.col("compiled")))
    assert both.agg(F.max(off)).first()[0] < 1e-9
    path = str(tmp_path / "model")
    forest.save_model(found.model, path)
    assert forest.score(forest.load_model(path), rows).count() == rows.count()


def test_a_missing_value_is_loud_in_any_sensor(flat):
    found, rows = flat
    with pytest.raises(Exception, match="null"):
        forest.score(found.model, rows.withColumn("sensor_9", F.lit(None).cast("double"))).collect()


def test_grid():
    assert len(forest.grid_points(forest.DEFAULT_GRID)) == 8
    with pytest.raises(ValueError, match="min_samples_split"):
        forest.grid_points({"min_samples_split": [2, 5]})


def test_missing_sensor_is_loud(spark, life, record):
    broken = spark.createDataFrame([{**record, "sensor_9": float("nan")}])
    with pytest.raises(Exception, match="NaN"):
        forest.score(life.model, broken).collect()
