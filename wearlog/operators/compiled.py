"""Forests as tables of nodes, scored by one native expression or, for a single record, without a job."""

import json
import math
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wearlog.operators.forest import PREDICTION, save_model
from wearlog.operators.trees import Forest
from wearlog.session import scratch_path
from wearlog.sources.tables import overwrite_table, read_table

NODES = "tree int, node int, feature int, threshold double, left int, right int, value double"


@dataclass(frozen=True)
class Compiled:
    """The nodes of all trees in arrays: ``feature`` is -1 in leaves, else rows with a value not above
    ``threshold`` go to ``left`` and all others, missing values too, to ``right``; ``roots`` are the trees."""

    features: list[str]
    feature: list[int]
    threshold: list[float]
    left: list[int]
    right: list[int]
    value: list[float]
    roots: list[int]
    depth: int

    def table(self, spark: SparkSession) -> DataFrame:
        """A row per node (``NODES``), for SQL."""
        ends = [*self.roots[1:], len(self.feature)]
        tree = [t for t, (a, b) in enumerate(zip(self.roots, ends)) for _ in range(a, b)]
        rows = zip(tree, range(len(tree)), self.feature, self.threshold, self.left, self.right, self.value)
        return spark.createDataFrame([tuple(row) for row in rows], NODES)

    def save(self, spark: SparkSession, path: str) -> None:
        """As a table of nodes, a row each, with the features' names."""
        names = F.array(*[F.lit(name) for name in self.features])
        overwrite_table(self.table(spark).withColumn("features", names).coalesce(1), path)

    @staticmethod
    def load(spark: SparkSession, path: str) -> "Compiled":
        trees: dict[int, dict[int, tuple]] = {}
        features: list[str] = []
        # As many rows as the model has nodes.
        for r in read_table(spark, path).toLocalIterator():
            features = r["features"]
            inner = r["feature"] if r["feature"] >= 0 else None
            trees.setdefault(r["tree"], {})[r["node"]] = (inner, r["threshold"], r["left"], r["right"], r["value"])
        return _flat(features, [trees[t] for t in sorted(trees)])

    def predict(self, record: dict[str, float]) -> float:
        """The prediction for one set of readings; runs no job."""
        x = [record.get(name) for name in self.features]
        total = 0.0
        for at in self.roots:
            while self.feature[at] >= 0:
                read = x[self.feature[at]]
                low = read is not None and not math.isnan(read) and read <= self.threshold[at]
                at = self.left[at] if low else self.right[at]
            total += self.value[at]
        return total / len(self.roots)

    def prediction(self) -> Column:
        """The prediction as an expression over the feature columns; its size does not depend on the model's,
        which is one constant of the plan."""
        arrays = {k: getattr(self, k) for k in ("feature", "threshold", "left", "right", "value", "roots")}
        kinds = (
            "feature array<int>, threshold array<double>, left array<int>, right array<int>, "
            "value array<double>, roots array<int>"
        )
        model = F.from_json(F.lit(json.dumps(arrays)), kinds)

        def mean(x: Column) -> Column:
            def step(at: Column, _: Column) -> Column:
                feature = F.get(model["feature"], at)
                low = F.get(x, feature) <= F.get(model["threshold"], at)
                below = F.when(low, F.get(model["left"], at)).otherwise(F.get(model["right"], at))
                return F.when(feature < 0, at).otherwise(below)

            def leaf(root: Column) -> Column:
                steps = F.sequence(F.lit(1), F.lit(self.depth))
                return F.aggregate(steps, root, step) if self.depth else root

            total = F.aggregate(
                model["roots"], F.lit(0.0), lambda sum, root: sum + F.get(model["value"], leaf(root))
            )
            return total / F.lit(float(len(self.roots)))

        readings = F.array(*[F.col(f"`{name}`").cast("double") for name in self.features])
        # Within a list of one, the readings are put together once per row.
        return F.transform(F.array(readings), mean)[0]


def _flat(features: list[str], trees: list[dict[int, tuple]]) -> Compiled:
    """``trees``: of each, node to (feature or None, threshold, left, right, value); node names are numbers, the
    root's is the least."""
    arrays: tuple[list, ...] = ([], [], [], [], [])
    roots, deepest = [], 0
    for nodes in trees:
        start = len(arrays[0])
        place = {name: start + i for i, name in enumerate(sorted(nodes))}
        depth = {min(nodes): 0}
        for name in sorted(nodes):
            feature, threshold, left, right, value = nodes[name]
            inner = feature is not None
            if inner:
                depth[left] = depth[right] = depth[name] + 1
            row = (feature, threshold, place[left], place[right], value) if inner else (-1, 0.0, place[name], place[name], value)
            for values, own in zip(arrays, row):
                values.append(own)
        roots.append(start)
        deepest = max(deepest, *depth.values())
    return Compiled(features, *arrays, roots, deepest)


def compile_forest(forest: Forest, model: int = 0) -> Compiled:
    """One model of a grown forest."""
    trees: dict[int, dict[int, tuple]] = {}
    for m, t, node, feature, threshold, value, _ in forest.nodes:
        if m == model:
            trees.setdefault(t, {})[node] = (feature, threshold, 2 * node, 2 * node + 1, value)
    return _flat(forest.features, [trees[t] for t in sorted(trees)])


def compile_model(spark: SparkSession, model: PipelineModel, path: str | None = None) -> Compiled:
    """A Spark ML forest (assembler, slicer if any, and trees over numbers), from the node table it is saved as.

    ``path`` is where it is saved already; else it is saved to the shared folder.
    """
    if path is None:
        path = scratch_path(spark, "model")
        save_model(model, path)
    assembler, *slicers, forest = model.stages
    names = list(assembler.getInputCols())
    for slicer in slicers:
        names = [names[i] for i in slicer.getIndices()]
    split = F.col("nodeData.split")
    nodes = spark.read.parquet(f"{path}/stages/{len(model.stages) - 1}_{forest.uid}/data").select(
        "treeID", "nodeData.id", split["featureIndex"].alias("feature"),
        F.get(split["leftCategoriesOrThreshold"], F.lit(0)).alias("threshold"),
        "nodeData.leftChild", "nodeData.rightChild", "nodeData.prediction",
    )
    trees: dict[int, dict[int, tuple]] = {}
    # As many rows as the model has nodes.
    for tree, node, feature, threshold, left, right, value in nodes.toLocalIterator():
        trees.setdefault(tree, {})[node] = (feature if feature >= 0 else None, threshold, left, right, value)
    return _flat(names, [trees[t] for t in sorted(trees)])


def score_compiled(compiled: Compiled, df: DataFrame) -> DataFrame:
    """The table with ``predicted_rul``; batch or stream."""
    return df.withColumn(PREDICTION, compiled.prediction())
