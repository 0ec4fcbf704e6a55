"""MinHash near-dedup (operator 2): ProbMinHash, banding and verification.

Similarity is the probability Jaccard similarity of documents as weighted sets of shingles (``SHINGLE``
consecutive words, weighted by how often they occur); with weights of 1 it is the Jaccard similarity.

1. Signatures: the shingles of a document arrive as Poisson processes whose rates are their weights; each
   arrival falls on one of ``BANDS * ROWS`` registers, which keeps its earliest. A shingle stops as soon
   as its next arrival is later than the latest register. Two registers agree with the probability
   Jaccard similarity. Documents with the same words are one node from here on.
2. Candidates share a band of ``ROWS`` registers. A pair of similarity 0.8 shares none of 28 bands of 5
   with probability 1.5e-5.
3. Verification computes the similarity from the texts. First each node meets the smallest node of its
   buckets, then the smallest node of each bucket that is not yet in its class. What is then still outside
   the class of its bucket's smallest node meets all nodes of the bucket that are in other classes: pair by
   pair in small buckets, block by block in large ones, where no pair becomes a row. Pairs within a class
   need no proof, so groups of copies cost a number of pairs in proportion to their size, and no link
   between classes is lost.
4. Classes are the connected components of the verified pairs.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wearlog.llm.components import components, joined_components
from wearlog.llm.flat import U64, Words, column_of, flat_text, slices, splitmix
from wearlog.llm.rows import in_batches, measured, scan
from wearlog.session import stored

SHINGLE, BANDS, ROWS = 5, 28, 5
#: Buckets with more pairs than this to look at are compared in blocks of so many nodes, or bytes of text, about.
FEW_PAIRS, BLOCK_NODES, BLOCK_BYTES = 20_000, 2048, 1 << 25
#: Common elements that a comparison of blocks looks at at a time, about.
MATCHES = 1 << 20
#: Pairs of one node that are verified together, about.
PART_PAIRS = 256
#: Arrivals made at a time, about.
ARRIVALS = 1 << 16


def shingles(words: Words, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingle hashes of all rows, ordered by row, their counts, and where rows begin.

    A row with fewer words than ``size`` has one shingle of all its words, one without words none.
    """
    hashes = words.hashes
    n_words = np.diff(words.first)
    n = np.where(n_words == 0, 0, np.maximum(1, n_words - size + 1))
    first = np.concatenate([[0], np.cumsum(n)])
    row = np.repeat(np.arange(len(n)), n)
    at = words.first[row] + np.arange(first[-1]) - first[row]
    mixed = np.zeros(len(at), U64)
    with np.errstate(over="ignore"):
        for i in range(size):
            place = at + i
            inside = place < words.first[row + 1]
            own = hashes[np.minimum(place, max(0, len(hashes) - 1))]
            mixed = np.where(inside, splitmix(mixed ^ own), mixed)
    order = np.lexsort((mixed, row))
    mixed, row = mixed[order], row[order]
    new = np.ones(len(mixed), bool)
    new[1:] = (mixed[1:] != mixed[:-1]) | (row[1:] != row[:-1])
    opens = np.flatnonzero(new)
    counts = np.diff(np.append(opens, len(mixed)))
    return mixed[opens], counts, np.searchsorted(row[opens], np.arange(len(n) + 1))


def signatures(
    elements: np.ndarray, weights: np.ndarray, first: np.ndarray, registers: int
) -> np.ndarray:
    """One row of registers per document; those of a document without elements are 0."""
    n_docs = len(first) - 1
    doc = np.repeat(np.arange(n_docs), np.diff(first))
    earliest = np.full(n_docs * registers, np.inf)
    holder = np.zeros(n_docs * registers, U64)
    latest = np.full(n_docs, np.inf)
    time = np.zeros(len(elements))
    active = np.arange(len(elements))
    step = 0
    while len(active):
        # The fewer elements are left, the more arrivals of each at a time.
        ahead = int(np.clip(ARRIVALS // len(active), 1, 64))
        steps = splitmix(np.arange(step, step + ahead).astype(U64))
        noise = splitmix(elements[active][:, None] ^ steps[None, :])
        gaps = -np.log(((noise >> U64(11)).astype(np.float64) + 0.5) / (1 << 53))
        arrival = np.cumsum(gaps / weights[active][:, None], axis=1) + time[active][:, None]
        time[active] = arrival[:, -1]
        early = arrival < latest[doc[active]][:, None]
        which, _ = np.nonzero(early)
        register = (splitmix(noise[early]) % U64(registers)).astype(np.int64)
        place = doc[active][which] * registers + register
        moment = arrival[early]
        np.minimum.at(earliest, place, moment)
        won = moment == earliest[place]
        holder[place[won]] = elements[active][which[won]]
        touched = np.unique(doc[active])
        latest[touched] = earliest.reshape(n_docs, registers)[touched].max(axis=1)
        active = active[time[active] < latest[doc[active]]]
        step += ahead
    return holder.reshape(n_docs, registers)


def band_keys(signature: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """A hash of each band and its number."""
    keys = np.tile(splitmix(np.arange(bands).astype(U64)), (len(signature), 1))
    parts = signature.reshape(len(signature), bands, rows)
    for i in range(rows):
        keys = splitmix(keys ^ parts[:, :, i])
    return keys.view(np.int64)


def _sign(bands: int, rows: int):
    def work(part: pa.RecordBatch) -> list[pa.Array]:
        words = Words(*flat_text(part.column(part.num_columns - 1)))
        hashes = words.hashes
        n_words = np.diff(words.first)
        # A document's words in order as one number: a sum of place-dependent mixes.
        doc = words.doc
        mixes = splitmix(hashes ^ splitmix((np.arange(len(hashes)) - words.first[doc]).astype(U64)))
        sums = np.concatenate([np.zeros(1, U64), np.cumsum(mixes, dtype=U64)])
        with np.errstate(over="ignore"):
            node = splitmix(sums[words.first[1:]] - sums[words.first[:-1]] + n_words.astype(U64))
        elements, counts, first = shingles(words)
        keys = band_keys(signatures(elements, counts, first, bands * rows), bands, rows)
        offsets = np.concatenate([[0], np.cumsum(np.where(n_words > 0, bands, 0))])
        lists = pa.ListArray.from_arrays(
            pa.array(offsets, pa.int32()), pa.array(keys[n_words > 0].reshape(-1))
        )
        return [
            pa.array(node.view(np.int64), mask=n_words == 0),
            pa.array(n_words),
            lists,
        ]

    return work


def probability_jaccard(a: np.ndarray, wa: np.ndarray, b: np.ndarray, wb: np.ndarray) -> float:
    """Of two weighted sets given as sorted elements and weights.

    The sum over common i of 1 / sum over all j of max(a_j / a_i, b_j / b_i).
    """
    if len(a) == 0 or len(b) == 0:
        return 0.0
    both, in_a, in_b = np.intersect1d(a, b, assume_unique=True, return_indices=True)
    if len(both) == 0:
        return 0.0
    common_a, common_b = wa[in_a].astype(np.float64), wb[in_b].astype(np.float64)
    only_a, only_b = wa.sum() - common_a.sum(), wb.sum() - common_b.sum()
    ratio = common_a / common_b
    order = np.argsort(ratio, kind="stable")
    ratio, common_a, common_b = ratio[order], common_a[order], common_b[order]
    # For i, elements with a higher ratio count with a_j / a_i, the others with b_j / b_i.
    from_a = only_a + np.cumsum(common_a[::-1])[::-1]
    before_b = only_b + np.concatenate([[0], np.cumsum(common_b)])[:-1]
    at = np.searchsorted(ratio, ratio, "left")
    return float((1 / (from_a[at] / common_a + before_b[at] / common_b)).sum())


def similar_rows(
    elements: np.ndarray, counts: np.ndarray, first: np.ndarray, a: np.ndarray, wa: np.ndarray, threshold: float
) -> np.ndarray:
    """The rows (of ``shingles``) whose similarity with the set ``a, wa`` reaches the threshold.

    No term of the similarity exceeds the smaller of an element's shares in both sets; rows whose sum of
    these is too small are left out at once.
    """
    sizes = np.add.reduceat(np.append(counts, 0), first[:-1]) * (np.diff(first) > 0)
    row = np.repeat(np.arange(len(first) - 1), np.diff(first))
    if len(a) == 0 or len(elements) == 0:
        return np.zeros(0, np.int64)
    place = np.minimum(np.searchsorted(a, elements), len(a) - 1)
    common = np.flatnonzero(a[place] == elements)
    shares = np.minimum(counts[common] / sizes[row[common]], wa[place[common]] / wa.sum())
    most = np.bincount(row[common], shares, minlength=len(first) - 1)
    return np.array(
        [
            i
            for i in np.flatnonzero(most >= threshold - 1e-9).tolist()
            if probability_jaccard(
                elements[first[i] : first[i + 1]], counts[first[i] : first[i + 1]], a, wa
            )
            >= threshold - 1e-12
        ],
        np.int64,
    )


def _verify(threshold: float):
    """Rows (u, v, part, body) in the order of (v, part), the text of v first (its u is null), to the
    pairs that are similar enough. One text of v is held at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        center: tuple[np.ndarray, np.ndarray] | None = None
        for batch in batches:
            for part in slices(batch, "body"):
                elements, counts, first = shingles(Words(*flat_text(column_of(part, "body"))))
                centers = np.flatnonzero(column_of(part, "u").is_null().to_numpy(zero_copy_only=False))
                edges, opened = [0, *centers.tolist(), part.num_rows], set(centers.tolist())
                good = []
                for low, high in zip(edges[:-1], edges[1:]):
                    if low in opened:
                        own = slice(first[low], first[low + 1])
                        center = elements[own].copy(), counts[own].copy()
                        low += 1
                    if low < high:
                        own = slice(first[low], first[high])
                        found = similar_rows(
                            elements[own], counts[own], first[low : high + 1] - first[low], *center, threshold
                        )
                        good.append(found + low)
                keep = pa.array(np.concatenate(good) if good else np.zeros(0, np.int64))
                yield pa.RecordBatch.from_arrays(
                    [column_of(part, "u").take(keep), column_of(part, "v").take(keep)],
                    names=["u", "v"],
                )

    return run


#: Tasks for work that is computing more than reading: by its amount, but enough for all cores.
TASKS_PER_CORE, PAIRS_PER_TASK, BLOCKS_PER_TASK = 3, 20_000, 8


def _tasks(spark: SparkSession, pieces: int, per_task: int) -> int:
    """A number of partitions, which Spark then does not join by their bytes."""
    enough = TASKS_PER_CORE * spark.sparkContext.defaultParallelism
    return max(1, min(pieces, max(enough, pieces // per_task)))


def verified(pairs: DataFrame, texts: DataFrame, threshold: float) -> DataFrame:
    """The pairs ``u, v`` of nodes whose texts are similar enough, stored.

    The text of v is sent once to each part of ``PART_PAIRS`` of its pairs, that of u once a pair.
    """
    sizes = pairs.groupBy("v").agg(F.ceil(F.count(F.lit(1)) / PART_PAIRS).alias("parts"))
    part = F.pmod(F.xxhash64("u"), F.col("parts")).alias("part")
    dealt = stored(pairs.join(sizes, "v").select("u", "v", part), "dealt-pairs")
    body = texts.select(F.col("node"), F.col("text").alias("body"))
    centers = (
        dealt.select("v", "part")
        .distinct()
        .join(body, F.col("v") == F.col("node"))
        .select(F.lit(None).cast("long").alias("u"), "v", "part", "body")
    )
    others = dealt.join(body, F.col("u") == F.col("node")).select("u", "v", "part", "body")
    rows = (
        centers.unionByName(others)
        .repartition(_tasks(pairs.sparkSession, dealt.count(), PAIRS_PER_TASK), "v", "part")
        .sortWithinPartitions("v", "part", F.col("u").asc_nulls_first())
    )
    return stored(in_batches(rows).mapInArrow(_verify(threshold), "u long, v long"), "verified")


def _with_class(pairs: DataFrame, classes: DataFrame, name: str) -> DataFrame:
    """``pairs`` with the class of the node in column ``name``; nodes without links are their own."""
    own = classes.select(F.col("node").alias("n"), F.col("component").alias("c"))
    joined = pairs.join(own, F.col(name) == F.col("n"), "left").drop("n")
    return joined.withColumn(f"class_{name}", F.coalesce("c", name)).drop("c")


def near_duplicates(
    docs: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    threshold: float = 0.8,
    bands: int = BANDS,
    rows: int = ROWS,
) -> DataFrame:
    """``doc_id, text_key, class_id, class_size, class_key`` for every row of ``docs``; ``class_id`` is the
    smallest id of the class, ``class_size`` its rows, ``class_key`` its smallest node (null for rows without
    words).

    - Words: what ``flat.Words`` says. Texts that agree in all words are in one class; texts with fewer
      words than a shingle are compared as a whole. Rows without words (null, empty, signs only) are
      classes of their own.
    - Repeated rows and rows that share an id are rows of their own; ids may be null, and a class of rows
      without id has no id.
    - An empty table gives an empty table; other columns are not looked at.
    - Nodes are told apart by 64 bits of their word sequence.
    """
    body = F.col(f"`{text}`")
    rows_in = docs.select(
        F.col(f"`{id}`").cast("long").alias("doc_id"), F.xxhash64(body).alias("text_key"), body.alias("body")
    )
    signed = stored(
        scan(rows_in, ["doc_id", "text_key"], F.col("body"), _sign(bands, rows),
             "node long; n_words long; bands array<long>"),
        "signatures",
    )
    keys = stored(
        signed.filter(F.col("node").isNotNull())
        .select("node", F.explode("bands").alias("key"))
        .distinct(),
        "bands",
    )
    buckets = (
        keys.groupBy("key")
        .agg(F.count(F.lit(1)).alias("size"), F.min("node").alias("leader"))
        .filter("size > 1")
    )
    # Stored, so that the join deals both sides anew and Spark can split a bucket that many nodes share.
    members = stored(keys.join(stored(buckets, "buckets"), "key"), "members")
    # One text for each node that has a candidate.
    wanted = members.select("node").distinct()
    holders = (
        signed.join(wanted, "node")
        .groupBy("node")
        .agg(F.min(F.struct(F.col("doc_id").isNull().alias("no"), "doc_id", "text_key")).alias("row"))
        .select("node", F.col("row.doc_id").alias("h_id"), F.col("row.text_key").alias("h_key"))
    )
    holders = stored(holders, "holders")
    texts = rows_in.join(
        measured(holders),
        F.col("doc_id").eqNullSafe(F.col("h_id")) & (F.col("text_key") == F.col("h_key")),
    ).select("node", F.col("body").alias("text"))
    texts = stored(texts.dropDuplicates(["node"]) if _repeats(signed) else texts, "texts")

    first = members.groupBy("node").agg(F.min("leader").alias("v")).select(F.col("node").alias("u"), "v")
    first = stored(first.filter("u <> v"), "pairs")
    classes = components(verified(first, texts, threshold))

    second = members.select(F.col("node").alias("u"), F.col("leader").alias("v")).distinct()
    second = _with_class(_with_class(second, classes, "u"), classes, "v").filter("class_u <> class_v")
    second = stored(second.select("u", "v").join(first, ["u", "v"], "left_anti"), "pairs")
    classes = joined_components(classes, verified(second, texts, threshold))

    few, many = _outside(members, classes)
    third = _bucket_pairs(few, signed, first.unionByName(second))
    classes = joined_components(classes, verified(third, texts, threshold))
    classes = joined_components(classes, _block_links(many, texts, threshold))

    placed = signed.select("doc_id", "text_key", "node").join(
        classes.select("node", "component"), "node", "left"
    )
    placed = placed.withColumn("component", F.coalesce("component", "node"))
    known = placed.filter(F.col("component").isNotNull())
    named = known.groupBy("component").agg(
        F.min("doc_id").alias("class_id"), F.count(F.lit(1)).alias("class_size")
    )
    named = stored(named, "class-names")
    grouped = known.join(named, "component").select(
        "doc_id", "text_key", "class_id", "class_size", F.col("component").alias("class_key")
    )
    alone = placed.filter(F.col("component").isNull()).select(
        "doc_id",
        "text_key",
        F.col("doc_id").alias("class_id"),
        F.lit(1).cast("long").alias("class_size"),
        F.col("component").alias("class_key"),
    )
    return grouped.unionByName(alone)


def _repeats(signed: DataFrame) -> bool:
    """Whether some row occurs twice."""
    twice = signed.groupBy("doc_id", "text_key").count().filter("count > 1")
    return not twice.isEmpty()


def _outside(members: DataFrame, classes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Of the buckets with nodes outside their leader's class: ``key, node, class_node, out`` and the numbers
    ``size`` and ``n_out`` of their nodes; those with few pairs of an outside and any node, and the others."""
    placed = _with_class(_with_class(members, classes, "node"), classes, "leader")
    out = F.col("class_node") != F.col("class_leader")
    mixed = placed.filter(out).groupBy("key").agg(F.count(F.lit(1)).alias("n_out"))
    placed = stored(
        placed.join(mixed, "key").select("key", "size", "n_out", "node", "class_node", out.alias("out")), "mixed"
    )
    few = F.col("size") * F.col("n_out") <= FEW_PAIRS
    return placed.filter(few), placed.filter(~few)


def _bucket_pairs(placed: DataFrame, signed: DataFrame, tested: DataFrame) -> DataFrame:
    """Untested pairs of different classes of which one is outside its bucket's class, each from the first
    bucket it shares; stored."""
    own = signed.select(F.col("node").alias("n"), "bands").dropDuplicates(["n"])
    dealt = placed.join(own, F.col("node") == F.col("n"))
    side = lambda rows, x: rows.select(
        F.col("key").alias(f"key_{x}"), F.col("node").alias(x), F.col("class_node").alias(f"class_{x}"),
        F.col("bands").alias(f"bands_{x}"), F.col("out").alias(f"out_{x}"),
    )
    once = (F.col("class_a") != F.col("class_b")) & (~F.col("out_b") | (F.col("a") > F.col("b")))
    first = F.array_intersect("bands_a", "bands_b")[0] == F.col("key_a")
    pairs = side(dealt.filter("out"), "a").join(
        side(dealt, "b"), (F.col("key_a") == F.col("key_b")) & once & first
    )
    pairs = pairs.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    return stored(pairs.join(tested, ["u", "v"], "left_anti"), "pairs")


class Block:
    """Nodes of a bucket as compact shingles, looked up by element: some 28 bytes a shingle."""

    def __init__(self, nodes: list[int], owners: list[int], parts: list[tuple]):
        self.nodes, self.owners = nodes, owners
        sizes = np.concatenate([np.diff(first) for _, _, first in parts])
        self.first = np.concatenate([[0], np.cumsum(sizes)])
        self.elements = np.concatenate([elements for elements, _, _ in parts])
        self.counts = np.concatenate([counts.astype(np.int32) for _, counts, _ in parts])
        self.row = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)
        self.n_shingles = np.bincount(self.row, self.counts, minlength=len(sizes))
        self.order = np.argsort(self.elements, kind="stable").astype(np.int32)
        self.sorted = self.elements[self.order]

    def row_of(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        own = slice(self.first[i], self.first[i + 1])
        return self.elements[own], self.counts[own].astype(np.int64)

    def shared_weight(self, elements: np.ndarray, counts: np.ndarray, first: np.ndarray) -> np.ndarray:
        """For each given row and each node: the sum over common elements of the smaller share, which
        their similarity does not exceed."""
        n_rows, n_nodes = len(first) - 1, len(self.nodes)
        row = np.repeat(np.arange(n_rows), np.diff(first))
        shares = counts / np.bincount(row, counts, minlength=n_rows)[row]
        low, high = np.searchsorted(self.sorted, elements, "left"), np.searchsorted(self.sorted, elements, "right")
        total = np.zeros(n_rows * n_nodes)
        ends = np.cumsum(high - low)
        start = 0
        while start < len(elements):
            done = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, done + MATCHES, "right")))
            n = (high - low)[start:stop]
            which = np.repeat(np.arange(start, stop), n)
            at = self.order[low[which] + np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n)]
            node = self.row[at]
            share = np.minimum(shares[which], self.counts[at] / self.n_shingles[node])
            total += np.bincount(row[which] * n_nodes + node, share, minlength=len(total))
            start = stop
        return total.reshape(n_rows, n_nodes)


def _linked_blocks(threshold: float):
    """Rows (key, i, j, side, node, class_node, body) in the order of the first four to links that join the
    nodes' classes: the nodes of side 0, a block, are held as shingles, those of side 1 meet them slice by
    slice.

    Classes that links of the block have joined already need no further link.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = block = None
        held: tuple[list, list, list] = ([], [], [])
        parent: dict[int, int] = {}

        def root(x: int) -> int:
            while parent.get(x, x) != x:
                x = parent[x]
            return x

        for batch in batches:
            for part in slices(batch, "body"):
                names = [column_of(part, name).to_numpy() for name in ("key", "i", "j", "side")]
                edges = np.any([np.diff(column) != 0 for column in names], axis=0)
                # Of one pair of blocks and one side each, and of no more nodes than a block has.
                opens = [0, *(np.flatnonzero(edges) + 1).tolist(), part.num_rows]
                for low, high in zip(opens[:-1], opens[1:]):
                    new, is_out = tuple(int(column[low]) for column in names[:3]), names[3][low] == 0
                    if new != pair:
                        pair, block, held, parent = new, None, ([], [], []), {}
                    links = []
                    for start in range(low, high, BLOCK_NODES):
                        own = part.slice(start, min(BLOCK_NODES, high - start))
                        nodes = column_of(own, "node").to_pylist()
                        owners = column_of(own, "class_node").to_pylist()
                        elements, counts, first = shingles(Words(*flat_text(column_of(own, "body"))))
                        if is_out:
                            held[0].extend(nodes)
                            held[1].extend(owners)
                            held[2].append((elements, counts.astype(np.int32), first))
                            continue
                        if block is None and held[0]:
                            block, held = Block(*held), ([], [], [])
                        if block is None:
                            continue
                        most = block.shared_weight(elements, counts, first)
                        for y, x in zip(*(i.tolist() for i in np.nonzero(most >= threshold - 1e-9))):
                            a, b = root(block.owners[x]), root(owners[y])
                            if a == b:
                                continue
                            one = slice(first[y], first[y + 1])
                            if (
                                probability_jaccard(*block.row_of(x), elements[one], counts[one])
                                >= threshold - 1e-12
                            ):
                                parent[max(a, b)] = min(a, b)
                                links.append((block.nodes[x], nodes[y]))
                    if links:
                        u, v = zip(*links)
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(u, pa.int64()), pa.array(v, pa.int64())], names=["u", "v"]
                        )

    return run


def _block_links(placed: DataFrame, texts: DataFrame, threshold: float) -> DataFrame:
    """Links between classes within large buckets, stored. Blocks of about ``BLOCK_NODES`` outside nodes, or
    fewer with ``BLOCK_BYTES`` of text, meet such blocks of the bucket's nodes; no pair of nodes is a row."""
    bytes_of = texts.select(F.col("node").alias("n"), F.octet_length("text").cast("long").alias("bytes"))
    blocks = lambda n, size: F.greatest(
        F.ceil(n / BLOCK_NODES), F.ceil(size / BLOCK_BYTES), F.lit(1).cast("long")
    )
    numbers = (
        placed.join(bytes_of, F.col("node") == F.col("n"))
        .groupBy("key")
        .agg(
            blocks(F.count(F.when(F.col("out"), 1)), F.sum(F.when(F.col("out"), F.col("bytes")))).alias("n_i"),
            blocks(F.count(F.lit(1)), F.sum("bytes")).alias("n_j"),
        )
    )
    numbers = stored(numbers, "blocks")
    n_blocks = numbers.agg(F.sum(F.col("n_i") * F.col("n_j"))).first()[0] or 0
    placed = placed.join(measured(numbers), "key")
    number = lambda n: F.pmod(F.xxhash64("node"), F.col(n))
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    outs = placed.filter("out").select(
        "key", "node", "class_node", number("n_i").alias("i"), every("n_j").alias("j"), F.lit(0).alias("side")
    )
    all_ = placed.select(
        "key", "node", "class_node", every("n_i").alias("i"), number("n_j").alias("j"), F.lit(1).alias("side")
    )
    body = texts.select(F.col("node").alias("n"), F.col("text").alias("body"))
    rows = (
        outs.unionByName(all_)
        .join(body, F.col("node") == F.col("n"))
        .select("key", "i", "j", "side", "node", "class_node", "body")
        .repartition(_tasks(texts.sparkSession, n_blocks, BLOCKS_PER_TASK), "key", "i", "j")
        .sortWithinPartitions("key", "i", "j", "side", "node")
    )
    return stored(in_batches(rows).mapInArrow(_linked_blocks(threshold), "u long, v long"), "block-links")
