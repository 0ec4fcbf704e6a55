"""Grown forests and compiled models."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from wearlog.operators import trees
from wearlog.operators.compiled import Compiled, compile_forest, compile_model, score_compiled
from wearlog.operators.forest import PREDICTION, fit_forest, score
from wearlog.operators.trees import (
    Bins,
    Growth,
    binned,
    equal_bins,
    fold_errors,
    grid_search,
    grow,
    quantile_bins,
)
from wearlog.plans.trainer import grow_life

FEATURES = ["sensor_1", "sensor_2", "sensor_3"]


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(5)
    out = []
    for i in range(300):
        x = [round(rng.uniform(0, 10), 1), float(rng.randint(0, 3)), 5.0]
        x[0] = None if i % 40 == 7 else x[0]
        label = None if i % 50 == 3 else int(x[0] or 12) + 4 * int(x[1]) + rng.randint(0, 3)
        out.append((i, *x, label, i * 3 // 300))
    return out


@pytest.fixture(scope="module")
def log(spark, rows):
    names = ", ".join(f"{c} double" for c in FEATURES)
    return spark.createDataFrame(rows, f"i int, {names}, RUL int, fold int").repartition(4)


def _plain_tree(rows, cuts, depth, least, leaf, node=1):
    """rows: (bins, label); node to (feature, threshold, value, n)."""
    labels = [y for _, y in rows]
    n, s = len(labels), sum(labels)
    own = {node: (None, None, s / n, n)}
    best = (1e-9 * sum(y * y for y in labels), None)
    if depth and n >= least:
        for f in range(len(cuts)):
            for b in sorted({x[f] for x, _ in rows})[:-1]:
                left = [y for x, y in rows if x[f] <= b]
                m, t = len(left), sum(left)
                if m >= leaf and n - m >= leaf:
                    gain = t * t / m + (s - t) * (s - t) / (n - m) - s * s / n
                    best = (gain, (f, b)) if gain > best[0] else best
    if best[1] is None:
        return own
    f, b = best[1]
    own = {node: (f, cuts[f][b], s / n, n)}
    for side, some in ((0, [r for r in rows if r[0][f] <= b]), (1, [r for r in rows if r[0][f] > b])):
        own |= _plain_tree(some, cuts, depth - 1, least, leaf, 2 * node + side)
    return own


def _bins(x, cuts):
    return [len(c) if v is None else sum(v > cut for cut in c) for v, c in zip(x, cuts)]


LIMITS = [(0, 2, 1), (1, 2, 1), (5, 2, 1), (5, 60, 1), (5, 2, 25), (4, 40, 10)]


@pytest.mark.parametrize("nodes_per_pass", [1, 4096])
def test_trees_equal_the_plain_version(log, rows, monkeypatch, nodes_per_pass):
    monkeypatch.setattr(trees, "NODES_PER_PASS", nodes_per_pass)
    limits = LIMITS if nodes_per_pass > 1 else LIMITS[-1:]
    bins = equal_bins(log, FEATURES, 8)
    assert bins.cuts[2] == []
    models = [
        Growth({"n_estimators": 1, "max_depth": d, "min_samples_split": s, "min_samples_leaf": l}, without, False)
        for d, s, l in limits for without in (None, 1)
    ]
    grown = grow(binned(log, bins), bins, models)
    for m, growth in enumerate(models):
        some = [(_bins(r[1:4], bins.cuts), r[4]) for r in rows if r[4] is not None and r[5] != growth.without]
        expected = _plain_tree(some, bins.cuts, *limits[m // 2])
        assert {n[2]: n[3:] for n in grown.of(m).nodes} == expected


def test_errors_and_the_best_point(log, rows):
    grid = {"n_estimators": [1], "max_depth": [1, 4], "min_samples_split": [2, 100]}
    bins = equal_bins(log, FEATURES, 8)
    found = grid_search(log, 3, grid, bins, bootstrap=False)
    for point, error in found.scores:
        folds = []
        for fold in range(3):
            some = [(_bins(r[1:4], bins.cuts), r[4]) for r in rows if r[4] is not None and r[5] != fold]
            tree = _plain_tree(some, bins.cuts, point["max_depth"], point["min_samples_split"], 1)
            squares = []
            for r in (r for r in rows if r[4] is not None and r[5] == fold):
                node, x = 1, _bins(r[1:4], bins.cuts)
                while tree[node][0] is not None:
                    f, cut = tree[node][:2]
                    node = 2 * node + (x[f] > bins.cuts[f].index(cut))
                squares.append((tree[node][2] - r[4]) ** 2)
            folds.append(np.sqrt(np.mean(squares)))
        assert error == pytest.approx(np.mean(folds))
    assert found.best == min(found.scores, key=lambda scored: scored[1])[0]
    with pytest.raises(ValueError, match="max_dept"):
        grid_search(log, 3, {"max_dept": [1]}, bins)


def test_drawn_rows(spark, log):
    counts = trees._weights(np.arange(200_000), 3, 42)
    assert counts.mean() == pytest.approx(1, abs=0.01) and counts.var() == pytest.approx(1, abs=0.02)
    assert (counts != trees._weights(np.arange(200_000), 4, 42)).mean() > 0.5
    bins = quantile_bins(log, FEATURES, 16)
    stored_rows = binned(log, bins)
    model = [Growth({"n_estimators": 12, "max_depth": 6}, 0)]
    first, again, other = grow(stored_rows, bins, model), grow(stored_rows, bins, model), grow(stored_rows, bins, model, 1)
    assert first == again and first != other
    assert len({n[3:] for n in first.nodes if n[2] == 1}) > 1
    spread = log.filter("fold = 0").agg(F.stddev_pop("RUL")).first()[0]
    assert fold_errors(stored_rows, bins, first, model)[0] < spread / 2


def test_quantile_bins_of_common_values(spark):
    frame = spark.range(1000).selectExpr("IF(id < 900, 1.0D, id) AS a", "1.0D AS b", "CAST(NULL AS DOUBLE) AS c")
    bins = quantile_bins(frame, ["a", "b", "c"], 8)
    assert bins.cuts[0][0] == 1.0 and bins.cuts[1:] == [[], []]
    assert equal_bins(frame, ["b", "c"]).cuts == [[], []]


def test_compiled_trees_score_as_they_were_grown(spark, log, rows, tmp_path):
    bins = equal_bins(log, FEATURES, 8)
    grown = grow(binned(log, bins), bins, [Growth({"n_estimators": 7, "max_depth": 4})])
    compiled = compile_forest(grown)
    compiled.save(spark, str(tmp_path / "model"))
    assert Compiled.load(spark, str(tmp_path / "model")) == compiled
    by_tree = [{n[2]: n for n in grown.nodes if n[1] == t} for t in range(7)]
    scored = {r["i"]: r for r in score_compiled(compiled, log).collect()}
    for r in rows:
        total = 0.0
        for tree in by_tree:
            node = 1
            while tree[node][3] is not None:
                x = r[1 + tree[node][3]]
                node = 2 * node + (x is None or x > tree[node][4])
            total += tree[node][5]
        assert scored[r[0]][PREDICTION] == pytest.approx(total / 7)
        assert compiled.predict(scored[r[0]].asDict()) == scored[r[0]][PREDICTION]
    # A tree that is one leaf, and no rows.
    leaf = compile_forest(grow(binned(log, bins), bins, [Growth({"n_estimators": 1, "max_depth": 0}, None, False)]))
    mean = log.agg(F.avg("RUL")).first()[0]
    assert leaf.predict({}) == pytest.approx(mean)
    assert score_compiled(leaf, log.limit(0)).collect() == []


def test_compiled_model_equals_spark_ml(spark, log):
    whole = log.na.fill(0.0).drop("i", "fold")
    model = fit_forest(whole, n_estimators=6, max_depth=5)
    compiled = compile_model(spark, model)
    both = score(model, score_compiled(compiled, whole).withColumnRenamed(PREDICTION, "ours"))
    assert both.filter(F.col("ours") != F.col(PREDICTION)).count() == 0
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("one", "one record")
    row = both.drop("ours").first().asDict()
    before = len(tracker.getJobIdsForGroup("one"))
    assert compiled.predict(row) == row[PREDICTION]
    assert len(tracker.getJobIdsForGroup("one")) == before
    table = compiled.table(spark)
    assert table.count() == len(compiled.feature) and table.select("tree").distinct().count() == 6


def test_training_run(spark, log, tmp_path):
    gold = str(tmp_path / "gold")
    whole = log.selectExpr("i DIV 10 AS engine_id", "i % 10 AS cycle", *FEATURES, "RUL")
    whole.write.parquet(f"{gold}/train")
    whole.limit(20).write.parquet(f"{gold}/test")
    grid = {"n_estimators": [3], "max_depth": [1, 5], "min_samples_split": [2, 250], "min_samples_leaf": [1]}
    life = grow_life(spark, gold, 3, grid)
    assert len(life.scores) == 4 and life.best["max_depth"] == 5
    assert life.predict().count() == 20 and life.rmse() < whole.agg(F.stddev_pop("RUL")).first()[0] / 2
    life.save(f"{gold}/model")
    assert Compiled.load(spark, f"{gold}/model") == life.compiled


def test_bins_are_ascending():
    bins = Bins(["a"], [[1.0, 2.0]])
    assert _bins([None], bins.cuts) == [2] and _bins([1.0], bins.cuts) == [0] and _bins([1.5], bins.cuts) == [1]
