"""Passages of many words that several documents hold, where they are too short in bytes for ``repeats``.

Words are lower-cased letters and digits, so passages match across changed blanks and punctuation. As there,
of any ``n_words`` consecutive words the run of ``gram`` words with the least hash is an anchor: equal passages
have the same one. Anchors of one document only are dropped, then those of which every row is known to hold
repeats already. Around the others every window of ``n_words`` words is hashed and counted.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wearlog.llm.flat import U64, Words, column_of, flat_text, prefix_sums, range_hashes, slices, splitmix
from wearlog.llm.repeats import _window_minima
from wearlog.llm.rows import DOC, join, measured
from wearlog.session import stored

#: Words of an anchor, of the passage's.
GRAM_SHARE = 0.625


def word_anchors(hashes: np.ndarray, first: np.ndarray, n_words: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and hashes of the anchors among the words of all rows; ``first``: where the rows' words begin."""
    if len(hashes) < n_words:
        return np.zeros(0, np.int64), np.zeros(0, U64)
    starts = np.arange(len(hashes) - gram + 1)
    grams = range_hashes(prefix_sums(splitmix(hashes)), starts, starts + gram)
    low = U64((1 << int(len(hashes)).bit_length()) - 1)
    minima = _window_minima((grams & ~low) | starts.astype(U64), n_words - gram + 1)
    row = np.searchsorted(first, np.arange(len(minima)), "right") - 1
    inside = np.arange(len(minima)) + n_words <= first[row + 1]
    places = np.unique((minima[inside] & low).astype(np.int64))
    return places, grams[places]


def _find(n_words: int, gram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "body"):
                words = Words(*flat_text(column_of(part, "body")))
                places, grams = word_anchors(words.hashes, words.first, n_words, gram)
                row = np.searchsorted(words.first, places, "right") - 1
                own = pa.array(row)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(grams.view(np.int64)),
                        *(column_of(part, c).take(own) for c in DOC),
                        pa.array((places - words.first[row]).astype(np.int32)),
                    ],
                    names=["gram", *DOC, "pos"],
                )

    return run


def _windows(n_words: int, gram: int):
    """Rows with the places of anchors to the hashes and places of all windows that hold one of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                one = batch.slice(i, 1)
                words = Words(*flat_text(column_of(one, "body")))
                hashes = words.hashes
                at = column_of(one, "places").flatten().to_numpy(zero_copy_only=False).astype(np.int64)
                around = np.unique((at[:, None] - np.arange(n_words - gram + 1)).ravel())
                around = around[(around >= 0) & (around + n_words <= len(hashes))]
                found = range_hashes(prefix_sums(splitmix(hashes)), around, around + n_words)
                name = pa.array(np.zeros(len(around), np.int64))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(found.view(np.int64)),
                        *(column_of(one, c).take(name) for c in DOC),
                        pa.array(around.astype(np.int32)),
                    ],
                    names=["window", *DOC, "start"],
                )

    return run


def _shared(rows: DataFrame, key: str) -> DataFrame:
    """The values of ``key`` that rows of two documents have. Rows of the same id and text are one."""
    document = F.xxhash64(*DOC)
    ends = rows.groupBy(key).agg(F.min(document).alias("a"), F.max(document).alias("b"))
    return ends.filter("a <> b").select(key)


def short_passages(
    docs: DataFrame, known: DataFrame, n_words: int = 51, id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``doc_id, text_key, n_passage_words`` of the rows not in ``known`` (stored, ``doc_id, text_key``) that hold a
    passage of ``n_words`` words which another document holds too: how many words lie in such passages.

    - Null and empty texts, and those of fewer words, hold none.
    - Rows of the same id and text are one document; a text with two ids is two.
    - A row's words are one task's: some 40 bytes of memory per byte of text.
    """
    gram = max(1, int(n_words * GRAM_SHARE))
    body = F.col(f"`{text}`")
    rows = docs.select(
        F.col(f"`{id}`").cast("long").alias("doc_id"), F.xxhash64(body).alias("text_key"), body.alias("body")
    ).filter(F.octet_length("body") >= 2 * n_words - 1)
    found = stored(
        rows.mapInArrow(_find(n_words, gram), "gram long, doc_id long, text_key long, pos int"), "word-anchors"
    )
    twice = stored(_shared(found, "gram"), "shared-anchors")
    candidates = stored(found.join(twice, "gram", "left_semi").distinct(), "shared-places")
    open_grams = join(candidates, measured(known), DOC, "left_anti").select("gram").distinct()
    left = candidates.join(measured(stored(open_grams, "open-anchors")), "gram", "left_semi")
    by_row = stored(left.groupBy(*DOC).agg(F.collect_set("pos").alias("places")), "open-places")
    holders = join(rows, measured(by_row.select(*DOC)), DOC, "left_semi")
    with_places = join(holders, by_row.hint("shuffle_hash"), DOC)
    windows = stored(
        with_places.mapInArrow(_windows(n_words, gram), "window long, doc_id long, text_key long, start int"),
        "word-windows",
    )
    shared = windows.join(stored(_shared(windows, "window"), "shared-windows"), "window", "left_semi")
    covered = F.aggregate(
        F.array_sort(F.collect_set("start")),
        F.struct(F.lit(0).cast("long").alias("n"), F.lit(-n_words).alias("last")),
        lambda state, at: F.struct(
            (state["n"] + F.least(at - state["last"], F.lit(n_words))).alias("n"), at.alias("last")
        ),
    )["n"]
    counted = shared.groupBy(*DOC).agg(covered.alias("n_passage_words"))
    return join(counted, measured(known), DOC, "left_anti")
