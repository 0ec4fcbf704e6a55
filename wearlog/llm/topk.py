"""Exact top-k search (operator 9): ball-tree branch and bound per shard.

Candidates are dealt to shards of about ``SHARD_ROWS`` rows by ranges of their length, so that shards of
short vectors can be left out as a whole. Each becomes a ball tree, stored once; the trees' roots are
packed in pieces of ``PIECE_ROOTS``.

1. Every query is sent to one shard, that with the best upper bound at its root, and searches its tree.
   The k-th score there is a lower bound of the final one, which all other shards share.
2. A query is sent only to the shards whose root's upper bound, ``q . c + |q| r``, reaches that score.
   In their trees a node is left out for the queries whose bound there is below their current k-th
   score, which starts from the shared one and rises; children are visited in the order of their bounds.
3. The shards' results of a query are merged in pieces of one list per shard.

Queries travel as rows. A task gets a tree once, then the queries for it in slices of ``SLICE_ROWS``. A
shard with very many of them is dealt to several tasks, each with up to ``MOST_PER_TASK`` queries.

Vectors of integers give exact scores as long as they stay below 2**53.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wearlog.llm.rows import measured
from wearlog.session import stored

SHARD_ROWS, LEAF_ROWS, SLICE_ROWS, PIECE_ROOTS = 8192, 64, 256, 1024
#: Queries that a task searches one tree for: fewer only where there would be too few tasks for the cores.
MOST_PER_TASK, TASKS_PER_CORE = 4096, 3

BLOBS = ["ids", "vectors", "nodes", "centers"]
TREE = "shard long, dim int, ids binary, vectors binary, nodes binary, centers binary, root binary"


def upper_bounds(balls: np.ndarray, queries: np.ndarray, norms: np.ndarray) -> np.ndarray:
    """At least the score of each query with any row of each ball (center, radius), rounding included."""
    centers, radii = balls[:, :-1], balls[:, -1] * (1 + 1e-9) + 1e-9
    raw = queries @ centers.T + norms[:, None] * radii
    return raw + 1e-9 * (1 + np.abs(raw) + norms[:, None] * np.sqrt((centers**2).sum(axis=1)))


class BallTree:
    """Nodes in an array: first row, end row, left child, right child (0 for leaves); the radius and
    center of each. Rows of a node stand together."""

    def __init__(self, ids, vectors, nodes, centers):
        self.ids, self.vectors, self.nodes, self.centers = ids, vectors, nodes, centers

    @classmethod
    def build(cls, ids: np.ndarray, vectors: np.ndarray) -> "BallTree":
        order = np.arange(len(ids))
        nodes, centers = [], []
        todo = [(0, len(ids), -1, 0)]
        while todo:
            start, end, parent, side = todo.pop()
            me = len(nodes)
            if parent >= 0:
                nodes[parent][2 + side] = me
            own = vectors[order[start:end]]
            center = own.mean(axis=0)
            apart = np.sqrt(((own - center) ** 2).sum(axis=1))
            nodes.append([start, end, 0, 0])
            centers.append(np.append(center, apart.max()))
            if end - start <= LEAF_ROWS:
                continue
            # Along the line from the farthest row to the one farthest from that, cut in the middle.
            one = own[apart.argmax()]
            other = own[((own - one) ** 2).sum(axis=1).argmax()]
            along = own @ (other - one)
            half = (end - start) // 2
            order[start:end] = order[start:end][np.argsort(along, kind="stable")]
            todo += [(start + half, end, me, 1), (start, start + half, me, 0)]
        return cls(ids[order], vectors[order], np.array(nodes, np.int64), np.array(centers))

    def bounds(self, node: int, queries: np.ndarray, norms: np.ndarray) -> np.ndarray:
        return upper_bounds(self.centers[node : node + 1], queries, norms)[:, 0]


class Search:
    """The best k of each query of a slice so far; ties go to the smaller id."""

    def __init__(self, ids: np.ndarray, queries: np.ndarray, k: int, least: np.ndarray):
        self.own, self.queries, self.k = ids, queries, k
        self.norms = np.sqrt((queries**2).sum(axis=1))
        self.scores = np.full((len(ids), k), -np.inf)
        self.found = np.full((len(ids), k), np.iinfo(np.int64).max)
        self.least = least
        """A lower bound of each query's k-th score over all shards."""

    def needed(self) -> np.ndarray:
        return np.maximum(self.least, self.scores[:, -1])

    def leaf(self, tree: BallTree, node: int, who: np.ndarray) -> None:
        start, end = tree.nodes[node, :2]
        ids = tree.ids[start:end]
        scores = self.queries[who] @ tree.vectors[start:end].T
        scores[ids[None, :] == self.own[who][:, None]] = -np.inf
        # Rows below the k-th score change nothing; for most queries all of a leaf are.
        some = np.flatnonzero(scores.max(axis=1) >= self.needed()[who])
        if len(some) == 0:
            return
        who, scores = who[some], scores[some]
        scores = np.concatenate([self.scores[who], scores], axis=1)
        ids = np.concatenate([self.found[who], np.broadcast_to(ids, (len(who), len(ids)))], axis=1)
        ids = np.where(scores == -np.inf, np.iinfo(np.int64).max, ids)
        best = np.lexsort((ids, -scores), axis=1)[:, : self.k]
        self.scores[who] = np.take_along_axis(scores, best, axis=1)
        self.found[who] = np.take_along_axis(ids, best, axis=1)

    def run(self, tree: BallTree) -> None:
        bounds = upper_bounds(tree.centers, self.queries, self.norms)
        todo = [(0, np.arange(len(self.own)))]
        while todo:
            node, who = todo.pop()
            # The k-th scores may have risen since the node was put aside. A bound that equals the k-th
            # score may hide a row with a smaller id.
            who = who[bounds[who, node] >= self.needed()[who]]
            if len(who) == 0:
                continue
            left, right = tree.nodes[node, 2:]
            if not left:
                self.leaf(tree, node, who)
                continue
            first = bounds[who, left] >= bounds[who, right]
            # Last in, first out: every query sees its better child first.
            later = [(right, who[first]), (left, who[~first])]
            sooner = [(left, who[first]), (right, who[~first])]
            todo += [(n, w) for n, w in later + sooner if len(w)]


def _matrix(column: pa.Array | pa.ChunkedArray, dim: int) -> np.ndarray:
    values = (column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column).flatten().to_numpy(zero_copy_only=False)
    return values.astype(np.float64).reshape(-1, dim)


def blob(values: np.ndarray) -> pa.Array:
    return pa.array([np.ascontiguousarray(values).tobytes()], pa.binary())


def _grow(key: tuple, rows: pa.Table) -> pa.Table:
    dim = key[1].as_py()
    ids = rows["id"].to_numpy()
    order = np.argsort(ids, kind="stable")
    tree = BallTree.build(ids[order], _matrix(rows["vector"], dim)[order])
    return pa.table(
        {
            "shard": [key[0].as_py()],
            "dim": pa.array([dim], pa.int32()),
            "ids": blob(tree.ids),
            "vectors": blob(tree.vectors),
            "nodes": blob(tree.nodes),
            "centers": blob(tree.centers),
            "root": blob(tree.centers[0]),
        }
    )


def _pack(key: tuple, rows: pa.Table) -> pa.Table:
    """The roots of up to ``PIECE_ROOTS`` trees, by the trees' numbers."""
    return pa.table(
        {
            "shard": [key[0].as_py()],
            "dim": pa.array([key[1].as_py()], pa.int32()),
            "ids": blob(rows["shard"].to_numpy().astype(np.int64)),
            "centers": pa.array([b"".join(rows["root"].to_pylist())], pa.binary()),
        }
    )


def _array(held: dict, name: str, kind: type, width: int = 0) -> np.ndarray:
    values = np.frombuffer(held[name], kind)
    return values.reshape(-1, width) if width else values


def _asked(held: dict, part: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids, vectors and shared k-th scores of the queries."""
    least = part.column("least").fill_null(-np.inf).to_numpy(zero_copy_only=False)
    return part.column("id").to_numpy(), _matrix(part.column("vector"), held["dim"]), least


def _homes(held: dict, part: pa.RecordBatch) -> list[pa.Array]:
    """For each query the root of the piece with the best bound."""
    ids, queries, _ = _asked(held, part)
    balls = _array(held, "centers", np.float64, held["dim"] + 1)
    bounds = upper_bounds(balls, queries, np.sqrt((queries**2).sum(axis=1)))
    best = bounds.argmax(axis=1)
    return [ids, _array(held, "ids", np.int64)[best], bounds[np.arange(len(ids)), best]]


def _reached(held: dict, part: pa.RecordBatch) -> list[pa.Array]:
    """For each query the piece's other shards that may hold a row of at least the shared k-th score."""
    ids, queries, least = _asked(held, part)
    shards = _array(held, "ids", np.int64)
    balls = _array(held, "centers", np.float64, held["dim"] + 1)
    bounds = upper_bounds(balls, queries, np.sqrt((queries**2).sum(axis=1)))
    home = part.column("home").to_numpy()
    who, where = np.nonzero((bounds >= least[:, None]) & (shards[None, :] != home[:, None]))
    first = np.searchsorted(who, np.arange(len(ids) + 1))
    return [ids, pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array(shards[where]))]


def _searched(k: int):
    def work(held: dict, part: pa.RecordBatch) -> list[pa.Array]:
        """The best rows of the tree for each query."""
        ids, queries, least = _asked(held, part)
        tree = BallTree(
            _array(held, "ids", np.int64),
            _array(held, "vectors", np.float64, held["dim"]),
            _array(held, "nodes", np.int64, 4),
            _array(held, "centers", np.float64, held["dim"] + 1),
        )
        search = Search(ids, queries, k, least)
        search.run(tree)
        hit = search.scores > -np.inf
        return [ids[np.nonzero(hit)[0]], search.found[hit], search.scores[hit]]

    return work


def _held(work, names: list[str]):
    """Runs over sorted rows: one that holds a tree or a piece, then the queries that it meets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = {}
        for batch in batches:
            holders = np.flatnonzero(batch.column("id").is_null().to_numpy(zero_copy_only=False))
            for start, end in zip([-1, *holders], [*holders, batch.num_rows]):
                if start >= 0:
                    held = batch.slice(start, 1).to_pylist()[0]
                for at in range(start + 1, end, SLICE_ROWS):
                    found = work(held, batch.slice(at, min(SLICE_ROWS, end - at)))
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in found], names=names)

    return run


def _meet(holders: DataFrame, askers: DataFrame, work, schema: str, name: str) -> DataFrame:
    """What ``work`` makes of every holder (shard, dim, blobs) and its askers (shard, dim, id, vector, least,
    home), stored. The blobs are sent once per task."""
    cores = holders.sparkSession.sparkContext.defaultParallelism
    counts = stored(askers.groupBy("shard", "dim").agg(F.count(F.lit(1)).alias("n")), f"{name}-counts")
    total = counts.agg(F.sum("n")).first()[0] or 0
    per_task = min(MOST_PER_TASK, max(SLICE_ROWS, -(-total // (TASKS_PER_CORE * cores))))
    parts = stored(
        counts.select("shard", "dim", F.ceil(F.col("n") / per_task).alias("parts")), f"{name}-parts"
    )
    tasks = parts.agg(F.sum("parts")).first()[0] or 1
    dealt = askers.join(measured(parts), ["shard", "dim"]).select(
        *askers.columns, F.pmod(F.xxhash64("id"), F.col("parts")).alias("part")
    )
    part = F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part")
    first = holders.join(measured(parts), ["shard", "dim"]).select(*holders.columns, part)
    rows = (
        first.unionByName(dealt, allowMissingColumns=True)
        .repartition(2 * tasks, "shard", "dim", "part")
        .sortWithinPartitions("shard", "dim", "part", F.col("id").asc_nulls_first())
    )
    names = [field.split()[0] for field in schema.split(", ")]
    return stored(rows.mapInArrow(_held(work, names), schema), name)


RESULT = "query_id long, id long, score double"


def _best(rows: DataFrame, k: int) -> DataFrame:
    """The first k rows of each query, at most k from each shard of it coming in."""
    entry = F.struct((-F.col("score")).alias("minus"), "id")
    return rows.groupBy("query_id").agg(
        F.slice(F.array_sort(F.collect_list(entry)), 1, k).alias("best")
    )


def top_k(
    rows: DataFrame,
    queries: DataFrame,
    k: int = 5,
    id: str = "vec_id",
    vector: str = "vector",
) -> DataFrame:
    """``query_id, rank, id, score``: the k rows with the highest inner product with each query.

    - ``rows`` and ``queries``: integer ids and arrays of numbers. Vectors that are null or empty, or hold
      null, NaN or infinite components, and rows without id take no part. Vectors meet only those of
      the same length.
    - A query never meets rows with its own id. Ties go to the smaller id. Rows that repeat count each;
      of queries with the same id the one that sorts first is used.
    - Queries with fewer than k candidates get all of them, none without any. Empty tables give none.
    """
    fine = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf")))

    def clean(table: DataFrame) -> DataFrame:
        return table.select(
            F.col(f"`{id}`").cast("long").alias("id"),
            F.col(f"`{vector}`").cast("array<double>").alias("vector"),
        ).filter(
            F.col("id").isNotNull() & (F.size("vector") > 0) & F.forall("vector", fine)
        ).withColumn("dim", F.size("vector"))

    candidates = stored(clean(rows), "vectors")
    shards = max(1, -(-candidates.count() // SHARD_ROWS))
    # Equal lengths, and rows that repeat, are cut anywhere: the row's number takes part in the order.
    length = F.aggregate("vector", F.lit(0.0), lambda sum, x: sum + x * x)
    number = F.xxhash64("id", F.monotonically_increasing_id())
    ranged = (
        candidates.select("dim", "id", "vector", length.alias("length"), number.alias("number"))
        .repartitionByRange(shards, "length", "number")
        .select(F.spark_partition_id().cast("long").alias("shard"), "dim", "id", "vector")
    )
    trees = stored(stored(ranged, "shards").groupBy("shard", "dim").applyInArrow(_grow, TREE), "trees")
    piece = F.floor(F.col("shard") / PIECE_ROOTS).alias("piece")
    pieces = stored(
        trees.select(piece, "dim", "shard", "root")
        .groupBy("piece", "dim")
        .applyInArrow(_pack, "shard long, dim int, ids binary, centers binary"),
        "roots",
    )
    trees = trees.select("shard", "dim", *BLOBS)
    asked = clean(queries).groupBy("id").agg(F.min(F.struct("dim", "vector")).alias("q"))
    asked = stored(asked.select("id", "q.dim", "q.vector"), "queries")
    unknown = [F.lit(None).cast("double").alias("least"), F.lit(None).cast("long").alias("home")]
    # Every query meets every piece of roots of its length: one for each PIECE_ROOTS * SHARD_ROWS rows.
    met = asked.join(measured(stored(pieces.select("shard", "dim"), "pieces")), "dim")
    homes = _meet(pieces, met.select("*", *unknown), _homes, "id long, home long, bound double", "homes")
    homes = homes.groupBy("id").agg(F.max_by("home", "bound").alias("home"))
    at_home = asked.join(homes, "id").withColumn("least", F.lit(None).cast("double"))
    at_home = stored(at_home.withColumn("shard", F.col("home")), "at-home")
    first = _meet(trees, at_home, _searched(k), RESULT, "first")
    least = (
        _best(first, k)
        .filter(F.size("best") == k)
        .select(F.col("query_id").alias("id"), (-F.element_at("best", -1)["minus"]).alias("least"))
    )
    known = stored(at_home.drop("least", "shard").join(least, "id", "left"), "known")
    met = known.join(measured(stored(pieces.select("shard", "dim"), "pieces")), "dim")
    reached = _meet(pieces, met, _reached, "id long, shards array<long>", "reached")
    away = known.join(reached.select("id", F.explode("shards").alias("shard")), "id")
    second = _meet(trees, away, _searched(k), RESULT, "second").unionByName(first)
    best = _best(second, k).select("query_id", F.posexplode("best").alias("at", "row"))
    return best.select(
        "query_id",
        (F.col("at") + 1).cast("int").alias("rank"),
        F.col("row")["id"].alias("id"),
        (-F.col("row")["minus"]).alias("score"),
    )
