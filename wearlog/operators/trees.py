"""Regression forests grown level by level from histograms, with all four usual limits.

Rows are stored once, each feature as the number of its bin. Growing a level is one pass over the stored rows
and one shuffle: tasks add up, for every node of every tree that is still growing, the rows, labels and squared
labels per feature and bin; these small histograms merge by sums, and the best split of a node is an aggregate
of its merged bins. Only splits reach the driver: a few numbers per node, as many as the model itself holds. The
trees of many models (points of a grid, folds) grow in the same passes.

A node is split if it is not yet ``max_depth`` deep, has ``min_samples_split`` rows at least, and a split leaves
``min_samples_leaf`` rows on either side and lowers the sum of squared errors. Of equal splits the one on the
first feature counts, then the lowest. A tree whose bootstrap sample is empty has no nodes.
"""

import sys
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wearlog.operators.folds import FOLD
from wearlog.schema import LABEL, sensor_columns
from wearlog.session import stored

# What runs in tasks is sent along whole: executors need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# The usual grid, 16 points.
GRID = {
    "n_estimators": [100, 200], "max_depth": [10, 20],
    "min_samples_split": [2, 5], "min_samples_leaf": [1, 2],
}
DEFAULTS = {"n_estimators": 100, "max_depth": 10, "min_samples_split": 2, "min_samples_leaf": 1}
MAX_BINS = 32
#: Histograms of so many nodes are added up in one pass; a wider level takes several.
NODES_PER_PASS = 4096
#: A split lowers the squared error by more than this share of the sum of squared labels, which is more than
#: what rounding does to it.
LEAST_GAIN = 1e-9

NODE = "model int, tree int, node long, feature int, threshold double, value double, n double"


@dataclass(frozen=True)
class Bins:
    """The places where a feature may be cut, ascending: bin b is above ``cuts[b - 1]`` and not above
    ``cuts[b]``."""

    features: list[str]
    cuts: list[list[float]]


def equal_bins(rows: DataFrame, features: list[str], n: int = MAX_BINS) -> Bins:
    """Cuts at equal distances between the least and the greatest value."""
    ends = rows.agg(*[f(c).alias(f"{k}_{c}") for c in features for k, f in (("lo", F.min), ("hi", F.max))]).first()
    cuts = []
    for c in features:
        low, high = ends[f"lo_{c}"], ends[f"hi_{c}"]
        flat = low is None or low == high
        cuts.append([] if flat else [low + (high - low) * i / n for i in range(1, n)])
    return Bins(features, cuts)


def quantile_bins(rows: DataFrame, features: list[str], n: int = MAX_BINS, accuracy: int = 10_000) -> Bins:
    """Cuts at quantiles (of rank error 1 / ``accuracy``); values that many rows share are one cut."""
    shares = [i / n for i in range(1, n)]
    found = rows.agg(*[F.percentile_approx(c, shares, accuracy).alias(c) for c in features], *[F.max(c).alias(f"hi_{c}") for c in features]).first()
    return Bins(features, [sorted({x for x in found[c] or [] if x < found[f"hi_{c}"]}) for c in features])


@dataclass
class Growth:
    """One model while it grows: its limits, the fold it leaves out, whether its rows are drawn."""

    point: dict
    without: int | None = None
    bootstrap: bool = True

    def limits(self) -> dict:
        return DEFAULTS | self.point


@dataclass(frozen=True)
class Forest:
    """Grown models: ``nodes`` as rows of ``NODE``. A tree's root is node 1; the rows of node i not above its
    threshold go to 2 i, the others to 2 i + 1; leaves have no feature."""

    features: list[str]
    nodes: list[tuple]

    def of(self, model: int) -> "Forest":
        return Forest(self.features, [n for n in self.nodes if n[0] == model])

    def table(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(self.nodes, NODE)


def _weights(rows: np.ndarray, model_tree: int, seed: int) -> np.ndarray:
    """How often a bootstrap sample holds each row: Poisson with mean 1, by row and tree alone."""
    with np.errstate(over="ignore"):
        x = rows.astype(np.uint64) + np.uint64((model_tree * 0x9E3779B97F4A7C15 + seed * 0xD6E8FEB86659FD93) % (1 << 64))
        for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB), (31, 1)):
            x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    uniform = (x >> np.uint64(11)).astype(np.float64) / (1 << 53)
    steps = np.cumsum(np.exp(-1) / np.cumprod([1.0, *range(1, 12)]))
    return np.searchsorted(steps, uniform, "right").astype(np.float64)


def _descend(bins: np.ndarray, splits: dict[int, tuple[int, int]]) -> np.ndarray:
    """The node each row comes to; ``splits``: node to (feature, last bin on the left)."""
    at = np.ones(len(bins), np.int64)
    if not splits:
        return at
    ids = np.array(sorted(splits), np.int64)
    feature, last = np.array([splits[i] for i in ids.tolist()], np.int64).T
    every = np.arange(len(bins))
    while True:
        place = np.minimum(np.searchsorted(ids, at), len(ids) - 1)
        inner = ids[place] == at
        if not inner.any():
            return at
        right = bins[every, feature[place]] > last[place]
        at = np.where(inner, 2 * at + right, at)


def _columns(batch: pa.RecordBatch, n_features: int) -> tuple[np.ndarray, ...]:
    """Row numbers, folds, labels, and bins as a table."""
    row, fold, label = (
        batch.column(batch.schema.get_field_index(c)).to_numpy(zero_copy_only=False) for c in ("row", "fold", "label")
    )
    flat = batch.column(batch.schema.get_field_index("bins")).flatten().to_numpy(zero_copy_only=False)
    return row, fold, label, flat.reshape(-1, n_features).astype(np.int64)


_HISTOGRAM = "model int, tree int, node long, feature int, bin int, n double, s double, q double"


def _histograms(shared, n_features: int, n_bins: int):
    """Tasks' histograms: of each wanted node, the rows, labels and squared labels per feature and bin."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees, seed = shared.value
        sums: dict[tuple[int, int, int], np.ndarray] = {}
        for batch in batches:
            row, fold, label, bins = _columns(batch, n_features)
            for model, tree, without, drawn, splits, wanted in trees:
                weight = _weights(row, model << 20 | tree, seed) if drawn else np.ones(len(row))
                if without is not None:
                    weight = weight * (fold != without)
                node = _descend(bins, splits)
                inside = np.isin(node, wanted) & (weight > 0)
                if not inside.any():
                    continue
                kinds, which = np.unique(node[inside], return_inverse=True)
                w, y, b = weight[inside], label[inside], bins[inside]
                place = (which[:, None] * n_features + np.arange(n_features)) * n_bins + b
                size = len(kinds) * n_features * n_bins
                added = np.stack([
                    np.bincount(place.ravel(), np.repeat(values, n_features), size)
                    for values in (w, w * y, w * y * y)
                ]).reshape(3, len(kinds), -1)
                for i, kind in enumerate(kinds.tolist()):
                    key = (model, tree, kind)
                    sums[key] = sums[key] + added[:, i] if key in sums else added[:, i]
        for (model, tree, kind), own in sums.items():
            filled = np.flatnonzero(own[0])
            n = len(filled)
            columns = [
                pa.array(np.full(n, model, np.int32)), pa.array(np.full(n, tree, np.int32)),
                pa.array(np.full(n, kind, np.int64)), pa.array((filled // n_bins).astype(np.int32)),
                pa.array((filled % n_bins).astype(np.int32)), *(pa.array(own[i][filled]) for i in range(3)),
            ]
            names = [f.split(" ")[0] for f in _HISTOGRAM.split(", ")]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return run


def best_splits(histograms: DataFrame, limits: DataFrame) -> DataFrame:
    """``model, tree, node, n, s, q, split``: the totals of each node, and the best of its allowed splits
    (``feature, bin`` as the last on the left), null without one.

    ``limits`` has a row per model: ``model, leaf, least`` (rows of a node that may be split).
    """
    node = ["model", "tree", "node"]
    merged = histograms.groupBy(*node, "feature", "bin").agg(*[F.sum(c).alias(c) for c in ("n", "s", "q")])
    by_feature = merged.groupBy(*node, "feature").agg(
        F.array_sort(F.collect_list(F.struct("bin", "n", "s", "q"))).alias("bins")  # at most as many as bins
    )
    total = lambda c: F.aggregate(
        "bins", F.lit(0.0), lambda t, b: t + b[c]
    )
    totals = by_feature.select(*node, "feature", "bins", *[total(c).alias(c) for c in ("n", "s", "q")])
    totals = totals.join(F.broadcast(limits), "model")
    zero = F.struct(F.lit(0.0).alias("n"), F.lit(0.0).alias("s"), F.lit(None).cast("struct<gain:double,feature:int,bin:int>").alias("best"))

    def step(state: Column, b: Column) -> Column:
        n, s = state["n"] + b["n"], state["s"] + b["s"]
        right_n, right_s = F.col("n") - n, F.col("s") - s
        gain = s * s / n + right_s * right_s / right_n - F.col("s") * F.col("s") / F.col("n")
        allowed = (F.col("n") >= F.col("least")) & (n >= F.col("leaf")) & (right_n >= F.col("leaf")) & (right_n > 0)
        better = allowed & (gain > F.coalesce(state["best"]["gain"], F.lit(LEAST_GAIN) * F.col("q")))
        found = F.struct(gain.alias("gain"), F.col("feature"), b["bin"].alias("bin"))
        return F.struct(n.alias("n"), s.alias("s"), F.when(better, found).otherwise(state["best"]).alias("best"))

    scanned = totals.withColumn("best", F.aggregate("bins", zero, step)["best"])
    # The greatest gain; of equal ones the first feature.
    order = F.struct(F.col("best.gain"), -F.col("feature"))
    return scanned.groupBy(*node).agg(
        *[F.max(c).alias(c) for c in ("n", "s", "q")],
        F.max_by("best", order).alias("split"),
    )


def _numbered(cuts: list[list[float]]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # A missing value is above all cuts.
            numbers = [
                np.searchsorted(own, batch.column(3 + i).to_numpy(zero_copy_only=False).astype(np.float64))
                for i, own in enumerate(cuts)
            ]
            flat = np.stack(numbers, axis=1).astype(np.int16) if numbers else np.zeros((batch.num_rows, 0), np.int16)
            places = pa.array(np.arange(batch.num_rows + 1) * len(cuts), pa.int32())
            lists = pa.ListArray.from_arrays(places, pa.array(flat.ravel()))
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], lists], names=["row", "fold", "label", "bins"])

    return run


def binned(train: DataFrame, bins: Bins) -> DataFrame:
    """Labelled rows stored as ``row, fold, label, bins``; row numbers are fixed by the stored table."""
    fold = F.col(FOLD).cast("int") if FOLD in train.columns else F.lit(-1)
    rows = train.filter(F.col(LABEL).isNotNull()).select(
        F.monotonically_increasing_id().alias("row"),
        fold.alias("fold"),
        F.col(LABEL).cast("double").alias("label"),
        *[F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(bins.features)],
    )
    return stored(
        rows.mapInArrow(_numbered(bins.cuts), "row long, fold int, label double, bins array<smallint>"), "binned"
    )


def grow(rows: DataFrame, bins: Bins, models: list[Growth], seed: int = 42) -> Forest:
    """Grow all trees of all models together over the stored ``rows`` (``binned``)."""
    spark = rows.sparkSession
    n_bins = max(len(c) for c in bins.cuts) + 1
    limits = spark.createDataFrame(
        [
            (m, float(g.limits()["min_samples_leaf"]), float(g.limits()["min_samples_split"]))
            for m, g in enumerate(models)
        ],
        "model int, leaf double, least double",
    )
    trees = [(m, t) for m, g in enumerate(models) for t in range(g.limits()["n_estimators"])]
    splits: dict[tuple[int, int], dict[int, tuple[int, int]]] = {tree: {} for tree in trees}
    open_nodes = [(m, t, 1) for m, t in trees]
    nodes: list[tuple] = []
    while open_nodes:
        then = []
        for start in range(0, len(open_nodes), NODES_PER_PASS):
            wanted: dict[tuple[int, int], list[int]] = {}
            for m, t, node in open_nodes[start : start + NODES_PER_PASS]:
                wanted.setdefault((m, t), []).append(node)
            work = [
                (m, t, models[m].without, models[m].bootstrap, splits[m, t], np.array(own))
                for (m, t), own in wanted.items()
            ]
            shared = spark.sparkContext.broadcast((work, seed))
            added = rows.mapInArrow(_histograms(shared, len(bins.features), n_bins), _HISTOGRAM)
            # A row per node of this level.
            for r in best_splits(added, limits).toLocalIterator():
                m, t, node, split = r["model"], r["tree"], r["node"], r["split"]
                deep = node.bit_length() - 1 >= models[m].limits()["max_depth"]
                value = r["s"] / r["n"]
                if split is None or deep:
                    nodes.append((m, t, node, None, None, value, r["n"]))
                    continue
                splits[m, t][node] = (split["feature"], split["bin"])
                cut = bins.cuts[split["feature"]][split["bin"]]
                nodes.append((m, t, node, split["feature"], cut, value, r["n"]))
                then += [(m, t, 2 * node), (m, t, 2 * node + 1)]
            shared.unpersist()
        open_nodes = sorted(then)
    return Forest(bins.features, sorted(nodes, key=lambda n: n[:3]))


def _squares(shared, n_features: int):
    """Of each model, rows of the fold it left out and the sum of their squared errors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        models = shared.value
        for batch in batches:
            _, fold, label, bins = _columns(batch, n_features)
            out: list[tuple] = []
            for model, without, trees in models:
                own = fold == without
                if own.any():
                    total = np.zeros(own.sum())
                    for splits, leaves, values in trees:
                        total += values[np.searchsorted(leaves, _descend(bins[own], splits))]
                    out.append((model, int(own.sum()), float(((total / len(trees) - label[own]) ** 2).sum())))
            if out:
                kinds = (pa.int32(), pa.int64(), pa.float64())
                arrays = [pa.array(c, k) for c, k in zip(zip(*out), kinds)]
                yield pa.RecordBatch.from_arrays(arrays, names=["model", "n", "square"])

    return run


def fold_errors(rows: DataFrame, bins: Bins, forest: Forest, models: list[Growth]) -> dict[int, float]:
    """The RMSE of each model on the rows of the fold it left out, all in one pass; models that had no rows to
    learn from, or none to judge, are not in it."""
    trees: dict[tuple[int, int], tuple[dict, dict]] = {}
    for m, t, node, feature, cut, value, _ in forest.nodes:
        splits, leaves = trees.setdefault((m, t), ({}, {}))
        if feature is None:
            leaves[node] = value
        else:
            splits[node] = (feature, bins.cuts[feature].index(cut))
    work = []
    for m, growth in enumerate(models):
        # A tree that drew no row has no nodes and no say.
        own = [trees[m, t] for t in range(growth.limits()["n_estimators"]) if (m, t) in trees]
        if not own:
            continue
        flat = [(s, np.array(sorted(l)), np.array([l[i] for i in sorted(l)])) for s, l in own]
        work.append((m, growth.without, flat))
    shared = rows.sparkSession.sparkContext.broadcast(work)
    sums = rows.mapInArrow(_squares(shared, len(bins.features)), "model int, n long, square double")
    found = sums.groupBy("model").agg(F.sqrt(F.sum("square") / F.sum("n")).alias("rmse")).collect()
    return {r["model"]: r["rmse"] for r in found}


@dataclass(frozen=True)
class GridSearch:
    """Mean error of every point over the folds, and the best point's model fitted on all rows."""

    forest: Forest
    best: dict
    scores: list[tuple[dict, float]] = field(default_factory=list)


def grid_search(
    folded: DataFrame,
    folds: int,
    grid: dict[str, list] | None = None,
    bins: Bins | None = None,
    bootstrap: bool = True,
    seed: int = 42,
) -> GridSearch:
    """Cross-validate all points of a grid at once over column ``fold``, then fit the best (the first of equal
    ones) on all rows."""
    grid = GRID if grid is None else grid
    if unknown := set(grid) - set(DEFAULTS):
        raise ValueError(f"unknown parameters {sorted(unknown)}; use {sorted(DEFAULTS)}")
    points = [dict(zip(grid, values)) for values in product(*grid.values())]
    features = sensor_columns(folded)
    labelled = folded.filter(F.col(LABEL).isNotNull())
    bins = bins or quantile_bins(labelled, features)
    rows = binned(labelled, bins)
    models = [Growth(p, fold, bootstrap) for p in points for fold in range(folds)]
    grown = grow(rows, bins, models, seed)
    errors = fold_errors(rows, bins, grown, models)
    worst = float("inf")
    scores = [
        (p, sum(errors.get(i * folds + fold, worst) for fold in range(folds)) / folds) for i, p in enumerate(points)
    ]
    best = min(scores, key=lambda scored: scored[1])[0]
    return GridSearch(grow(rows, bins, [Growth(best, None, bootstrap)], seed), best, scores)
