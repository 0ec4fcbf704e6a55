"""Conversation prefix trie (operator 11): vertical bitmaps per shard, merged where shards share a prefix.

1. Conversations are dealt to partitions by ranges of their ids, and each partition is cut into shards of about
   ``SHARD_ROWS`` turns.
2. A shard is indexed vertically: for every (position, turn) a bitset of the conversations that have this turn
   there. Depth first, a node's bitset is intersected with the postings of the next position: the lowest
   conversation that is left names the next turn to look up, so every child costs one intersection and each
   posting is met once. Popcounts are the nodes' members; those with no further turn are its end list.
3. A node is named by 128 bits of its path, the same in all shards. Nodes of several shards are merged. What
   is summed over a subtree adds up over shards but for the nodes counted in several of them. These
   corrections run up the tree of shared nodes by doubling: after r rounds a node holds those of 2**r levels.
4. End lists stay in pieces, one per shard, in the order of ids; hashes read the pieces as a stream.

Only hashes of turns are shuffled, never texts. A prefix that a third of all conversations begin with is one
row per shard when shards are merged. A conversation of more than ``SHARD_ROWS`` turns is a shard of its own,
a path that leaves its task in pieces.
"""

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wearlog.llm.flat import column_of
from wearlog.llm.rows import measured
from wearlog.session import stored

#: Turns of a shard, about; a conversation is never cut in two.
SHARD_ROWS = 1 << 15
BATCH_ROWS = 1 << 13

PATH = ["p1", "p2"]
PARENT = ["up1", "up2"]
#: The root's name, and that of what is above it.
ROOT = (0, 0)
NODE = (
    "p1 long, p2 long, up1 long, up2 long, depth long, shard long, conv_id long, up_conv_id long, n_convs long, "
    "n_children long, n_leaves long, n_ends long, ends string, words long, member_words long, node_words long"
)
_NAMES = [field.split(" ")[0] for field in NODE.split(", ")]
_KINDS = [pa.string() if field.endswith("string") else pa.int64() for field in NODE.split(", ")]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def child_path(path: tuple[int, int], key: tuple[int, int]) -> tuple[int, int]:
    """The name of the node that a turn leads to."""
    whole = b"".join(x.to_bytes(8, "little", signed=True) for x in (*path, *key))
    both = xxhash.xxh3_128_intdigest(whole)
    return _signed(both >> 64), _signed(both & ((1 << 64) - 1))


def shard_nodes(conversations: list[tuple[int, list[tuple]]]) -> Iterator[list]:
    """The trie of one shard, as rows of ``NODE``.

    ``conversations``: ids in order, each with its turns (key, key, words) by position.
    """
    postings: list[dict[tuple[int, int], int]] = []
    words: dict[tuple[int, int], int] = {}
    ends: dict[int, int] = {}
    for i, (_, turns) in enumerate(conversations):
        bit = 1 << i
        for at, (k1, k2, n) in enumerate(turns):
            if at == len(postings):
                postings.append({})
            postings[at][k1, k2] = postings[at].get((k1, k2), 0) | bit
            words[k1, k2] = n
        ends[len(turns)] = ends.get(len(turns), 0) | bit

    lowest = lambda bits: (bits & -bits).bit_length() - 1
    shard = conversations[0][0]
    out: list[list] = []
    # Bitset, depth, path, words of the last turn, index of the parent.
    todo = [((1 << len(conversations)) - 1, 0, ROOT, 0, -1)]
    while todo:
        bits, depth, path, n_words, up = todo.pop()
        first = conversations[lowest(bits)][0]
        above = out[up][0:2] + [out[up][6]] if up >= 0 else [None, None, None]
        own = len(out)
        ending = bits & ends.get(depth, 0)
        left, children = bits & ~ending, 0
        while left:
            k1, k2, n = conversations[lowest(left)][1][depth]
            found = left & postings[depth][k1, k2]
            left ^= found
            children += 1
            todo.append((found, depth + 1, child_path(path, (k1, k2)), n, own))
        ids = []
        while ending:
            ids.append(str(conversations[lowest(ending)][0]))
            ending &= ending - 1
        members = bits.bit_count()
        out.append([
            *path, *above[:2], depth, shard, first, above[2], members, children, int(not children),
            len(ids), ",".join(ids), n_words, members * n_words, n_words, up,
        ])
    # Parents come before their children: sums run from the end.
    for row in reversed(out):
        up = row.pop()
        if up >= 0:
            for i in (10, 14, 15):
                out[up][i] += row[i]
    return out


def _path_nodes(conv: int, turns: Iterator[tuple], length: int, total: int) -> Iterator[list]:
    """The nodes of a conversation that is a shard of its own; ``total`` words in all its turns."""
    path, above, n_words = ROOT, (None, None), 0
    left = total
    for depth in range(length + 1):
        last = depth == length
        yield [
            *path, *above, depth, conv, conv, conv if depth else None, 1, int(not last), 1, int(last),
            str(conv) if last else "", n_words, left, left,
        ]
        if not last:
            left -= n_words
            k1, k2, n_words = next(turns)
            above, path = path, child_path(path, (k1, k2))


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    names = ("conv_id", "length", "total", "pos", "k1", "k2", "words")
    for batch in batches:
        for start in range(0, batch.num_rows, BATCH_ROWS):
            part = batch.slice(start, BATCH_ROWS)
            yield from zip(*(column_of(part, name).to_pylist() for name in names))


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted turns (each conversation begins with a row at position -1) to the nodes of their shards."""

    def nodes() -> Iterator[list]:
        shard: list[tuple[int, list]] = []
        size = 0
        rows = _rows(batches)
        for conv, length, total, _, _, _, _ in rows:
            # The row at -1; the conversation's turns follow it.
            if shard and size + length > SHARD_ROWS:
                yield from shard_nodes(shard)
                shard, size = [], 0
            if length > SHARD_ROWS:
                yield from _path_nodes(conv, (next(rows)[4:] for _ in range(length)), length, total)
            else:
                shard.append((conv, [next(rows)[4:] for _ in range(length)]))
                size += length + 1
        if shard:
            yield from shard_nodes(shard)

    def batch(rows: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), _KINDS)], names=_NAMES)

    out: list[list] = []
    for node in nodes():
        out.append(node)
        if len(out) == BATCH_ROWS:
            yield batch(out)
            out = []
    if out:
        yield batch(out)


def turn_keys(role: Column, text: Column) -> tuple[Column, Column]:
    """128 bits of a turn, as two columns."""
    return F.xxhash64(role, text), F.xxhash64(F.lit("second"), text, role)


def numbered_turns(turns: DataFrame) -> DataFrame:
    """``conv_id, pos`` (from 0)``, k1, k2, words`` of conversations in the order of ``turn``.

    Null roles and texts are empty; turns without a number stand first; of the same number, in an order that
    depends on their content only. Rows without a conversation are left out, as they are no path.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    k1, k2 = turn_keys(role, text)
    words = F.size(F.regexp_extract_all(text, F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))).cast("long")
    rows = turns.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        k1.alias("k1"), k2.alias("k2"), words.alias("words"),
    )
    order = Window.partitionBy("conv_id").orderBy(F.asc_nulls_first("turn"), "k1", "k2")
    return rows.select("conv_id", (F.row_number().over(order) - 1).cast("long").alias("pos"), "k1", "k2", "words")


def with_heads(numbered: DataFrame, ids: DataFrame, family: Column, heads: Column, most: int) -> DataFrame:
    """Conversations whose first ``heads`` turns (``most`` at most) come from the conversation ``family``:
    its first turns, all if fewer, then their own turns after as many.

    ``numbered`` is a stored table of ``numbered_turns``; ``ids`` has every conversation once; both columns
    are expressions over ``conv_id``. A conversation that is left without turns has no row.
    """
    lent = (
        numbered.filter(F.col("pos") < most)
        .groupBy("conv_id")
        .agg(F.array_sort(F.collect_list(F.struct("pos", "k1", "k2", "words"))).alias("lent"))
        .withColumnRenamed("conv_id", "family")
    )
    lent = stored(lent.join(ids.select(family.alias("family")).distinct(), "family", "left_semi"), "heads")
    known = measured(lent)
    given = ids.select("conv_id", family.alias("family"), heads.cast("int").alias("n")).join(known, "family")
    first = given.filter("n > 0").select("conv_id", F.explode(F.slice("lent", 1, F.col("n"))).alias("t"))
    n_lent = known.select("family", F.size("lent").alias("n_lent"))
    own = (
        numbered.select("*", family.alias("family"), heads.cast("int").alias("n"))
        .filter("pos >= n")
        .join(n_lent, "family", "left")
        .withColumn("pos", F.col("pos") - F.col("n") + F.least("n", F.coalesce("n_lent", F.lit(0))))
    )
    columns = ["conv_id", "pos", "k1", "k2", "words"]
    return first.select("conv_id", "t.*").unionByName(own.select(*columns))


@dataclass(frozen=True)
class Trie:
    """``nodes``: a row per node; ``ends`` are the ids of conversations that end there, comma-joined, or null
    where the node lies in several shards. ``pieces`` has the lists of these, one per shard (``part``, in the
    order of ids)."""

    nodes: DataFrame
    pieces: DataFrame


def _up(shared: DataFrame, columns: list[str]) -> DataFrame:
    """``p1, p2`` and, of each column, the sum over the node's subtree. Rounds: the depth's logarithm."""
    rows = shared.select(*PATH, *PARENT, *columns)
    while not rows.filter(F.col("up1").isNotNull()).isEmpty():
        below = (
            rows.filter(F.col("up1").isNotNull())
            .groupBy(*PARENT)
            .agg(*[F.sum(c).alias(f"more_{c}") for c in columns])
            .select(F.col("up1").alias("p1"), F.col("up2").alias("p2"), *[f"more_{c}" for c in columns])
        )
        above = rows.select(
            *[F.col(c).alias(up) for c, up in zip(PATH, PARENT)],
            *[F.col(up).alias(f"next_{up}") for up in PARENT],
        )
        rows = stored(
            rows.join(measured(stored(below, "below")), PATH, "left")
            .join(measured(stored(above, "above")), PARENT, "left")
            .select(
                *PATH,
                *[F.col(f"next_{up}").alias(up) for up in PARENT],
                *[(F.col(c) + F.coalesce(f"more_{c}", F.lit(0))).alias(c) for c in columns],
            ),
            "summed",
        )
    return rows.select(*PATH, *columns)


def prefix_trie(turns: DataFrame, ids: DataFrame) -> Trie:
    """The trie of all beginnings of conversations.

    ``turns`` has ``conv_id, pos, k1, k2, words``, positions from 0 without gaps; ``ids`` every ``conv_id``
    once, those without turns included. A node has its path's name ``p1, p2``, ``conv_id`` (its smallest
    member), ``depth``, ``parent_conv_id`` (null for the root), ``n_convs`` (members), ``n_children``,
    ``n_leaves`` and ``saved_tokens`` (over its subtree, the words of its last turn times members less one).

    - Conversations without turns are members of the root only, and end there.
    - Conversations that are the same share all nodes. Turns of equal ``k1, k2`` are one.
    - Without any conversation there is no node. Other columns are not looked at.
    """
    sizes = ids.select("conv_id").join(
        turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("length"), F.sum("words").alias("total")),
        "conv_id",
        "left",
    )
    tops = sizes.select(
        "conv_id", F.coalesce("length", F.lit(0)).alias("length"), F.coalesce("total", F.lit(0)).alias("total"),
        F.lit(-1).cast("long").alias("pos"), *[F.lit(0).cast("long").alias(c) for c in ("k1", "k2", "words")],
    )
    nothing = [F.lit(None).cast("long").alias(c) for c in ("length", "total")]
    rows = stored(
        tops.unionByName(turns.select("conv_id", *nothing, "pos", "k1", "k2", "words")), "trie-turns"
    )
    parts = max(2 * rows.sparkSession.sparkContext.defaultParallelism, rows.count() // (4 * SHARD_ROWS))
    dealt = rows.repartitionByRange(min(parts, 100_000), "conv_id").sortWithinPartitions("conv_id", "pos")
    local = stored(dealt.mapInArrow(_shards, NODE), "shard-nodes")
    sums = ["n_convs", "n_children", "n_leaves", "n_ends", "member_words", "node_words"]
    merged = stored(
        local.groupBy(*PATH).agg(
            *[F.first(c).alias(c) for c in (*PARENT, "depth", "words")],
            *[F.min(c).alias(c) for c in ("conv_id", "up_conv_id")],
            *[F.sum(c).alias(c) for c in sums],
            F.count(F.lit(1)).alias("shards"),
            F.first("ends").alias("ends"),
            F.count_if(F.col("n_children") == 0).alias("local_leaves"),
        ),
        "merged-nodes",
    )
    shared = stored(merged.filter("shards > 1"), "shared-nodes")
    # Of a shared node, what shards count more often than once.
    childless = (F.col("n_children") == 0).cast("long")
    twice = shared.select(
        *PATH, *PARENT,
        (F.col("local_leaves") - childless).alias("leaves_twice"),
        ((F.col("shards") - 1) * F.col("words")).alias("words_twice"),
    )
    summed = _up(twice, ["leaves_twice", "words_twice"])
    again = (
        shared.filter(F.col("up1").isNotNull())
        .groupBy(*PARENT)
        .agg(F.sum(F.col("shards") - 1).alias("children_twice"))
        .select(F.col("up1").alias("p1"), F.col("up2").alias("p2"), "children_twice")
    )
    mended = stored(
        shared.join(summed, PATH).join(measured(stored(again, "again")), PATH, "left").select(
            *PATH, F.col("conv_id").alias("shared_id"), "leaves_twice", "words_twice", "children_twice"
        ),
        "mended",
    )
    known = measured(mended)
    above = known.select(*[F.col(c).alias(up) for c, up in zip(PATH, PARENT)], F.col("shared_id").alias("above"))
    less = lambda c, by: (F.col(c) - F.coalesce(by, F.lit(0))).alias(c)
    saved = F.col("member_words") - F.col("node_words") + F.coalesce("words_twice", F.lit(0))
    nodes = merged.join(known.drop("shared_id"), PATH, "left").join(above, PARENT, "left").select(
        *PATH,
        "conv_id",
        "depth",
        F.coalesce("above", "up_conv_id").alias("parent_conv_id"),
        "n_convs",
        less("n_children", "children_twice"),
        less("n_leaves", "leaves_twice"),
        saved.alias("saved_tokens"),
        "n_ends",
        F.when(F.col("shards") == 1, F.col("ends")).alias("ends"),
    )
    parted = local.filter("n_ends > 0").join(measured(shared.select(*PATH)), PATH, "left_semi")
    return Trie(nodes, parted.select(*PATH, F.col("shard").alias("part"), F.col("ends").alias("ids")))


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    now, digest = None, None
    names = [*PATH, "digest"]
    for batch in batches:
        out: list[tuple] = []
        columns = [column_of(batch, name).to_pylist() for name in (*PATH, "ids")]
        for p1, p2, ids in zip(*columns):
            if now == (p1, p2):
                digest.update(b",")
            else:
                if now:
                    out.append((*now, digest.hexdigest()))
                now, digest = (p1, p2), hashlib.sha256()
            digest.update(ids.encode())
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], names=names)
    if now:
        yield pa.RecordBatch.from_arrays([pa.array([x]) for x in (*now, digest.hexdigest())], names=names)


def with_ends_digest(trie: Trie) -> DataFrame:
    """The nodes with ``ends_sha256``, the hash of the whole comma-joined end list. Lists in pieces are sorted
    by piece and read as a stream, so a task holds one piece."""
    pieces = trie.pieces.repartition(*PATH).sortWithinPartitions(*PATH, "part")
    digests = stored(pieces.mapInArrow(_digests, "p1 long, p2 long, digest string"), "end-digests")
    own = F.sha2(F.coalesce("ends", F.lit("")), 256)
    joined = trie.nodes.join(measured(digests), PATH, "left")
    return joined.withColumn("ends_sha256", F.coalesce("digest", own)).drop("digest")
