"""Suffix-array dedup (operator 7): bytes covered by long strings that occur elsewhere.

Sorting every suffix of the corpus would move each byte hundreds of times. Instead:

1. Texts that occur twice as a whole need no sorting; one row of each goes on.
2. Anchors: of any ``length`` consecutive bytes, the gram of ``length / 4`` bytes with the least hash is an
   anchor (about one in ``3 / 8`` of ``length`` bytes). Equal strings of ``length`` bytes have the same
   anchor at the same place, so a repeated string has an anchor that occurs twice.
3. Anchors that occur once in the corpus are dropped. Each other one takes along its context, the bytes that
   strings of ``length`` bytes around it can reach; equal contexts are one from here on.
4. The contexts of an anchor are suffix-sorted, rightwards and, reversed, leftwards, by deep-shallow sorting
   (``suffix_sort``). Common prefixes in both orders tell which windows around the anchor occur twice.
5. Covered ranges go back to the rows and are cut out.

An anchor with more than ``GROUP_CONTEXTS`` different contexts is split: windows that begin in the same
part of the reach share a longer string, whose hash becomes the new group, and see less of their contexts, of
which equal ones are again taken as one. Parts are split until groups are small; a part of one window has one
context.

Grams, whole contexts and the strings of split groups are compared by 64-bit hashes, windows by their bytes.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wearlog.llm.flat import (
    BYTE_CODE,
    SLICE_BYTES,
    U64,
    column_of,
    flat_text,
    prefix_sums,
    range_hashes,
    slices,
)
from wearlog.llm.rows import DOC, join, measured
from wearlog.llm.suffix_sort import deep_shallow
from wearlog.session import stored

#: Different contexts that one task sorts at most.
GROUP_CONTEXTS = 20_000
#: Parts that the beginnings of windows in a large group are split into.
PARTS = 4


def _window_minima(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` consecutive values."""
    n = len(values) - width + 1
    padded = np.pad(values, (0, -len(values) % width), constant_values=np.iinfo(U64).max)
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).reshape(-1)
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    return np.minimum(behind[:n], ahead[width - 1 : width - 1 + n])


def anchors(text: np.ndarray, at: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and gram hashes of the anchors of all rows, in order."""
    gram = length // 4
    if len(text) < length:
        return np.zeros(0, np.int64), np.zeros(0, U64)
    sums = prefix_sums(BYTE_CODE[text])
    starts = np.arange(len(text) - gram + 1)
    hashes = range_hashes(sums, starts, starts + gram)
    bits = int(len(text)).bit_length()
    low = U64((1 << bits) - 1)
    # Of equal hashes the first place counts, which equal strings agree on.
    packed = (hashes & ~low) | starts.astype(U64)
    minima = _window_minima(packed, length - gram + 1)
    # Windows within one row only.
    inside = np.zeros(len(minima) + 1, np.int64)
    sizes = np.diff(at)
    long = sizes >= length
    np.add.at(inside, at[:-1][long], 1)
    np.add.at(inside, at[1:][long] - length + 1, -1)
    chosen = np.zeros(len(starts), bool)
    chosen[(minima[np.cumsum(inside[:-1]) > 0] & low).astype(np.int64)] = True
    places = np.flatnonzero(chosen)
    return places, hashes[places]


def _find_anchors(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "body"):
                text, at = flat_text(column_of(part, "body"))
                if part.num_rows == 1 and len(text) > 2 * SLICE_BYTES:
                    # A very long text in overlapping blocks: windows are judged by themselves.
                    found: dict[int, int] = {}
                    for low in range(0, len(text), SLICE_BYTES):
                        block = text[low : low + SLICE_BYTES + length - 1]
                        own, hashes = anchors(block, np.array([0, len(block)]), length)
                        found.update(zip((own + low).tolist(), hashes.tolist()))
                    places = np.array(list(found), np.int64)
                    hashes = np.array(list(found.values()), U64)
                else:
                    places, hashes = anchors(text, at, length)
                row = np.searchsorted(at, places, "right") - 1
                own = pa.array(row)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(hashes.view(np.int64)),
                        column_of(part, "doc_id").take(own),
                        column_of(part, "text_key").take(own),
                        pa.array(places - at[row]),
                    ],
                    names=["gram", "doc_id", "text_key", "pos"],
                )

    return run


def _contexts(length: int):
    """Rows with their repeated anchors to one row per anchor: its context, once per batch, and where it
    occurs."""
    gram = length // 4
    reach = length - gram

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bodies = column_of(batch, "body").cast(pa.binary())
            places, grams = column_of(batch, "places"), column_of(batch, "grams")
            for i in range(batch.num_rows):
                text = bodies[i].as_py()
                out = {"gram": [], "context_key": [], "left": [], "context": [], "pos": []}
                for place, own in zip(places[i].as_py(), grams[i].as_py()):
                    low = max(0, place - reach)
                    context = text[low : place + gram + reach]
                    key = xxhash.xxh3_64_intdigest(context, seed=place - low)
                    out["gram"].append(own)
                    out["context_key"].append(key - (1 << 64) if key >> 63 else key)
                    out["left"].append(place - low)
                    out["context"].append(context)
                    out["pos"].append(place)
                n = len(out["gram"])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(out["gram"], pa.int64()),
                        pa.array(out["context_key"], pa.int64()),
                        pa.array(out["left"], pa.int32()),
                        pa.array(out["context"], pa.binary()),
                        pa.array(out["pos"], pa.int64()),
                        column_of(batch, "doc_id").take(pa.array([i] * n, pa.int64())),
                        column_of(batch, "text_key").take(pa.array([i] * n, pa.int64())),
                    ],
                    names=[*out, "doc_id", "text_key"],
                )

    return run


def repeated_windows(
    contexts: list[bytes], lefts: list[int], gram: int, reach: int, low: int, high: int
) -> list[tuple[int, int] | None]:
    """For each context of an anchor, the least and the greatest distance before the anchor, within
    ``low`` and ``high``, at which a window of ``gram + reach`` bytes begins that another context has at
    the same distance.

    In the order of the right sides, strings that share ``reach - d`` bytes are neighbours, in the order of
    the reversed left sides those that share ``d`` bytes; a window at distance d occurs twice if two
    contexts are neighbours in both. This changes only where d passes a common prefix.
    """
    n = len(contexts)
    if n < 2:
        return [None] * n
    right, right_lcp = deep_shallow([c[l + gram :][:reach] for c, l in zip(contexts, lefts)])
    left, left_lcp = deep_shallow([c[:l][::-1][:reach] for c, l in zip(contexts, lefts)])
    distances = {low, high}
    distances.update(d for d in left_lcp if low <= d <= high)
    distances.update(reach - r for r in right_lcp if low <= reach - r <= high)
    out: list[tuple[int, int] | None] = [None] * n
    if n > 64:
        rank_r, rank_l = np.argsort(right), np.argsort(left)
        steps_r, steps_l = np.array(right_lcp), np.array(left_lcp)
        least, most = np.full(n, -1), np.full(n, -1)
        for d in sorted(distances):
            class_r = np.cumsum(steps_r < reach - d)[rank_r]
            class_l = np.cumsum(steps_l < d)[rank_l]
            _, back, counts = np.unique(
                class_r * (n + 1) + class_l, return_inverse=True, return_counts=True
            )
            twice = counts[back] > 1
            most[twice] = d
            least[twice & (least < 0)] = d
        return [(int(a), int(b)) if b >= 0 else None for a, b in zip(least, most)]
    for d in sorted(distances):
        class_r, class_l = [0] * n, [0] * n
        step = 0
        for i, shared in zip(right, right_lcp):
            step += shared < reach - d
            class_r[i] = step
        step = 0
        for i, shared in zip(left, left_lcp):
            step += shared < d
            class_l[i] = step
        first: dict[tuple[int, int], int] = {}
        for i, own in enumerate(zip(class_r, class_l)):
            if own in first:
                for j in (first[own], i):
                    out[j] = (out[j][0] if out[j] else d, d)
            else:
                first[own] = i
    return out


WINDOWS = "group long, key long, least int, most int"


def _sorted_group(length: int):
    gram = length // 4
    reach = length - gram

    def run(key: tuple, rows: pa.Table) -> pa.Table:
        low, high = rows["low"][0].as_py(), rows["high"][0].as_py()
        found = repeated_windows(
            rows["context"].to_pylist(), rows["left"].to_pylist(), gram, reach, low, high
        )
        keep = pa.array([i for i, own in enumerate(found) if own], pa.int64())
        return pa.table(
            {
                "group": rows["group"].take(keep),
                "key": rows["key"].take(keep),
                "least": pa.array([own[0] for own in found if own], pa.int32()),
                "most": pa.array([own[1] for own in found if own], pa.int32()),
            }
        )

    return run


def _feasible(length: int) -> tuple[Column, Column]:
    """The least and greatest distance at which a window lies within its context."""
    room = F.octet_length("context") - F.col("left")
    return F.greatest(F.col("low"), F.lit(length) - room), F.least(F.col("high"), F.col("left"))


def _split(items: DataFrame, length: int) -> DataFrame:
    """Each item once for each part of its windows' beginnings: ``group, key`` of the item, and of the
    part. A part's group is the string that all its windows share; its context is cut down to what these
    windows reach, so that contexts which differ farther off become one."""
    width = F.ceil((F.col("high") - F.col("low") + 1) / PARTS)
    lows = F.transform(F.sequence(F.lit(0), F.lit(PARTS - 1)), lambda i: F.col("low") + i * width)
    parts = items.select("*", width.alias("width"), F.explode(lows).alias("part")).filter("part <= high")
    parts = parts.withColumn(
        "high", F.least(F.col("high"), F.col("part") + F.col("width") - 1).cast("int")
    ).withColumn("low", F.col("part").cast("int"))
    least, most = _feasible(length)
    parts = parts.filter(least <= most)
    size = F.lit(length) - (F.col("high") - F.col("low"))
    shared = F.substring(F.col("context"), F.col("left") - F.col("low") + 1, size)
    left = F.least("left", "high")
    reach = F.lit(length) - F.col("low") + left
    cut = F.substring(F.col("context"), F.col("left") - left + 1, reach)
    return parts.select(
        "group",
        "key",
        F.xxhash64(shared, F.col("low"), F.col("high"), F.col("group")).alias("new_group"),
        F.xxhash64(cut, left).alias("new_key"),
        "low",
        "high",
        left.alias("left"),
        cut.alias("context"),
        "n",
    )


def _found_windows(contexts: DataFrame, length: int) -> DataFrame:
    """``gram, context_key, least, most`` of the contexts (which have occurred ``n`` times) with windows
    that occur twice."""
    reach = length - length // 4
    items = contexts.select(
        F.col("gram").alias("group"), F.col("context_key").alias("key"),
        F.lit(0).alias("low"), F.lit(reach).alias("high"), "left", "context", "n",
    )
    holders = contexts.select(
        "gram", "context_key", F.col("gram").alias("group"), F.col("context_key").alias("key")
    )
    least, most = _feasible(length)
    found = None
    while True:
        sizes = items.groupBy("group").agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
        sizes = stored(sizes, "groups")
        small = sizes.filter(F.col("size") <= GROUP_CONTEXTS).select("group")
        large = sizes.filter(F.col("size") > GROUP_CONTEXTS).select("group")
        by_order = (
            items.join(small, "group").groupBy("group").applyInArrow(_sorted_group(length), WINDOWS)
        )
        # An item that occurs twice repeats all of its windows.
        whole = items.filter("n > 1").select("group", "key", least.alias("least"), most.alias("most"))
        own = holders.join(by_order.unionByName(whole), ["group", "key"]).select(
            "gram", "context_key", "least", "most"
        )
        found = own if found is None else found.unionByName(own)
        if large.isEmpty():
            break
        parts = stored(_split(items.join(measured(large), "group"), length), "parts")
        holders = stored(
            holders.join(parts.select("group", "key", "new_group", "new_key"), ["group", "key"]).select(
                "gram", "context_key", F.col("new_group").alias("group"), F.col("new_key").alias("key")
            ),
            "holders",
        )
        first = [F.first(c).alias(c) for c in ("low", "high", "left", "context")]
        items = stored(
            parts.groupBy(F.col("new_group").alias("group"), F.col("new_key").alias("key")).agg(
                *first, F.sum("n").alias("n")
            ),
            "parts",
        )
    return found.groupBy("gram", "context_key").agg(
        F.min("least").alias("least"), F.max("most").alias("most")
    )


def repeated_spans(docs: DataFrame, length: int, id: str, text: str) -> DataFrame:
    """``doc_id, text_key, whole, spans`` of the rows that hold repeated bytes: ``whole`` for texts that
    occur twice, else where covered ranges begin and end, unmerged."""
    body = F.col(f"`{text}`")
    rows = docs.select(
        F.col(f"`{id}`").cast("long").alias("doc_id"), F.xxhash64(body).alias("text_key"), body.alias("body")
    ).filter(F.octet_length("body") >= length)
    names = stored(rows.select(*DOC, F.md5("body").alias("digest")), "texts")
    copies = (
        names.groupBy("digest")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.min(F.struct(F.col("doc_id").isNull().alias("no"), "doc_id", "text_key")).alias("first"),
        )
        .filter("n > 1")
        .select("digest", F.col("first.doc_id").alias("first_id"))
    )
    copied = names.join(copies, "digest")
    whole = stored(copied.select(*DOC).distinct(), "copies")
    others = copied.filter(~F.col("doc_id").eqNullSafe(F.col("first_id"))).select(*DOC).distinct()
    others = stored(others, "other-copies")
    single = join(rows, measured(others), DOC, "left_anti")
    found = stored(
        single.mapInArrow(_find_anchors(length), "gram long, doc_id long, text_key long, pos long"),
        "anchors",
    )
    twice = found.groupBy("gram").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("gram")
    # Stored, so that the join deals both sides anew and Spark can split an anchor that occurs often.
    candidates = found.join(stored(twice, "repeated"), "gram", "left_semi").distinct()
    by_row = stored(
        candidates.groupBy(*DOC).agg(F.collect_list(F.struct("pos", "gram")).alias("l")).select(
            *DOC, F.col("l.pos").alias("places"), F.col("l.gram").alias("grams")
        ),
        "candidates",
    )
    holders = join(rows, measured(by_row.select(*DOC)), DOC, "left_semi")
    # One row of those that repeat as a whole: repeats are known already.
    with_places = join(holders, by_row.hint("shuffle_hash"), DOC)
    around = stored(
        with_places.mapInArrow(
            _contexts(length),
            "gram long, context_key long, left int, context binary, pos long, doc_id long, text_key long",
        ),
        "contexts",
    )
    distinct = around.groupBy("gram", "context_key").agg(
        F.count(F.lit(1)).alias("n"), F.first("left").alias("left"), F.first("context").alias("context")
    )
    distinct = stored(distinct, "distinct-contexts")
    windows = stored(_found_windows(distinct, length), "windows")
    spans = (
        around.select(*DOC, "gram", "context_key", "pos")
        .join(windows, ["gram", "context_key"])
        .select(
            *DOC,
            (F.col("pos") - F.col("most")).alias("start"),
            (F.col("pos") - F.col("least") + length).alias("end"),
        )
        .groupBy(*DOC)
        .agg(F.collect_set(F.struct("start", "end")).alias("spans"))
    )
    whole = whole.withColumn("whole", F.lit(True))
    spans = join(spans, whole.drop("whole"), DOC, "left_anti")
    nothing = F.lit(None).cast("array<struct<start:long,end:long>>").alias("spans")
    return whole.select(*DOC, "whole", nothing).unionByName(
        spans.select(*DOC, F.lit(False).alias("whole"), "spans")
    )


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        kept, removed = [], []
        for body, whole, spans in zip(
            column_of(batch, "body").cast(pa.binary()),
            column_of(batch, "whole").to_pylist(),
            column_of(batch, "spans"),
        ):
            text = body.as_py() or b""
            if whole:
                kept.append(b"")
                removed.append([{"start": 0, "end": len(text)}])
                continue
            runs: list[list[int]] = []
            for span in sorted((s["start"], s["end"]) for s in spans.as_py() or ()):
                if runs and span[0] <= runs[-1][1]:
                    runs[-1][1] = max(runs[-1][1], span[1])
                else:
                    runs.append(list(span))
            edges = [0, *(x for run in runs for x in run), len(text)]
            kept.append(b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2])))
            removed.append([{"start": a, "end": b} for a, b in runs])
        kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        yield pa.RecordBatch.from_arrays(
            [*(column_of(batch, name) for name in DOC), pa.array(kept, pa.binary()), pa.array(removed, kind)],
            names=[*DOC, "kept", "removed"],
        )


def drop_repeats(
    docs: DataFrame, length: int = 400, id: str = "doc_id", text: str = "text", spans: DataFrame | None = None
) -> DataFrame:
    """``doc_id, text_key, kept, removed`` for every row of ``docs``: the bytes left of the text as UTF-8 and the
    maximal removed runs (start, end), in order.

    A byte is removed if a string of ``length`` bytes that covers it also starts anywhere else, in the same
    row or another; strings are judged on the input. ``length`` is 8 or more.

    - Null and empty texts are empty and lose nothing, as do texts shorter than ``length``.
    - Rows that repeat, or have the same text, lose all of it if it is long enough. Ids may be null or repeat;
      rows are told apart by id and a 64-bit hash of the text.
    - ``kept`` is binary: a cut may split a character. Other columns are not looked at.
    - ``spans`` are the stored ``repeated_spans`` of ``docs``, if they are at hand.
    """
    if length < 8:
        raise ValueError("length must be 8 or more")
    body = F.col(f"`{text}`")
    rows = docs.select(
        F.col(f"`{id}`").cast("long").alias("doc_id"), F.xxhash64(body).alias("text_key"), body.alias("body")
    )
    if spans is None:
        spans = stored(repeated_spans(docs, length, id, text), "spans")
    marked = join(rows, spans.hint("shuffle_hash"), DOC, "left")
    kind = "doc_id long, text_key long, kept binary, removed array<struct<start:long,end:long>>"
    return marked.select(*DOC, "body", "whole", "spans").mapInArrow(_cut, kind)
