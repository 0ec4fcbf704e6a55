"""Quality rules (operator 13): lines that too many documents of a host hold, and what is left without them.

1. One pass over the texts gives each row's counts, and the hashes of its normalised lines (words
   lower-cased, digits as 0, blanks between and around them ignored), each once with the places it stands at.
2. Distinct documents are counted per host and line. A line is *frequent* if more than ``max_docs`` documents
   of its host hold it, or more than ``max_share`` of them and three at least.
3. Frequent lines are removed. Rows that keep less than ``min_left`` of their words are depleted: they go, as
   do rows that fail a base rule.

Only hashes and counts are shuffled, never texts. A line that a third of all documents hold is combined to one
row per task before it is counted.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wearlog.llm.flat import (
    AS_IT_IS,
    BYTE_CODE,
    LOWER,
    NOT_BLANK,
    Words,
    column_of,
    flat_text,
    prefix_sums,
    range_hashes,
    slices,
    splitmix,
)
from wearlog.llm.rows import DOC, join, measured, unused
from wearlog.session import stored

#: What counts as a symbol.
SYMBOLS = b"#*$%&|<>"
IS_SYMBOL = np.isin(AS_IT_IS, np.frombuffer(SYMBOLS, np.uint8))
#: Lines differ neither by case nor by their numbers.
FOLD = LOWER.copy()
FOLD[48:58] = 48

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
_LINES = "array<struct<line:long,words:long,places:array<int>>>"


def _groups(row: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order in which equal pairs are neighbours (stable), and where in it another pair begins."""
    order = np.lexsort((key, row))
    row, key = row[order], key[order]
    new = np.ones(len(order), bool)
    new[1:] = (row[1:] != row[:-1]) | (key[1:] != key[:-1])
    return order, new


def _sequence_hashes(hashes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64 bits of each range of word hashes."""
    return range_hashes(prefix_sums(splitmix(hashes)), starts, ends)


class Measures:
    """The counts of each row of a flat text, and its lines that hold a word."""

    def __init__(self, text: np.ndarray, at: np.ndarray):
        n = len(at) - 1
        words = Words(text, at, NOT_BLANK, AS_IT_IS)
        row = words.doc
        total = lambda marks, rows: np.bincount(rows[marks], minlength=n).astype(np.int64)
        byte_row = np.repeat(np.arange(n), np.diff(at))
        self.n_words = np.diff(words.first).astype(np.int64)
        self.word_chars = total(NOT_BLANK[text] & ((text & 0xC0) != 0x80), byte_row)
        self.n_symbols = total(IS_SYMBOL[text], byte_row)

        # Every row begins a line, and so does what follows a \n.
        breaks = np.flatnonzero(text == 10)
        line = np.searchsorted(breaks, words.starts) + row
        opens = np.ones(len(line), bool)
        opens[1:] = line[1:] != line[:-1]
        first = np.flatnonzero(opens)
        last = np.append(first[1:], len(line))
        self.row = row[first]
        self.words = last - first
        self.place = line[first] - (np.searchsorted(breaks, at[:-1]) + np.arange(n))[self.row]
        edges = np.concatenate([[-1], breaks, [len(text)]])
        which = np.searchsorted(breaks, words.starts[first])
        begin = np.maximum(edges[which] + 1, at[self.row])
        end = np.minimum(edges[which + 1], at[self.row + 1])
        same = range_hashes(prefix_sums(BYTE_CODE[text]), begin, end)
        order, new = _groups(self.row, same)
        self.n_dup_lines = total(~new, self.row[order])
        folded = range_hashes(prefix_sums(BYTE_CODE[FOLD[text]]), words.starts, words.ends)
        self.hashes = _sequence_hashes(folded, first, last)

        # Words that stand in a window of three which occurs twice.
        at_three = np.flatnonzero(row[:-2] == row[2:]) if len(row) > 2 else np.zeros(0, np.int64)
        windows = _sequence_hashes(words.hashes, at_three, at_three + 3)
        order, new = _groups(row[at_three], windows)
        group = np.cumsum(new) - 1
        often = at_three[order[np.bincount(group)[group] > 1]] if len(group) else at_three
        repeated = np.zeros(len(row), bool)
        for i in range(3):
            repeated[often + i] = True
        self.n_repeat_words = total(repeated, row)

    def lines(self) -> pa.Array:
        """Each row's different lines: hash, words in all, places."""
        n = len(self.n_words)
        order, new = _groups(self.row, self.hashes)
        begins = np.flatnonzero(new)
        counts = np.bincount(self.row[order][begins], minlength=n)
        words = np.add.reduceat(self.words[order], begins) if len(begins) else np.zeros(0, np.int64)
        offsets = lambda sizes: pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32())
        places = pa.ListArray.from_arrays(
            offsets(np.diff(np.append(begins, len(order)))), pa.array(self.place[order], pa.int32())
        )
        fields = [pa.array(self.hashes[order][begins].view(np.int64)), pa.array(words, pa.int64()), places]
        return pa.ListArray.from_arrays(
            offsets(counts), pa.StructArray.from_arrays(fields, ["line", "words", "places"])
        )


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "body"):
            found = Measures(*flat_text(column_of(part, "body")))
            counts = [pa.array(getattr(found, name)) for name in COUNTS]
            yield pa.RecordBatch.from_arrays(
                [*(column_of(part, name) for name in [*DOC, "host"]), *counts, found.lines()],
                names=[*DOC, "host", *COUNTS, "lines"],
            )


def _named(docs: DataFrame, id: str, text: str, host: str | None) -> tuple[Column, Column, Column]:
    """Id, key of text and host, key of the host."""
    by = F.col(f"`{host}`").cast("string") if host else F.lit(None).cast("string")
    body = F.col(f"`{text}`")
    return F.col(f"`{id}`").cast("long"), F.xxhash64(by, body), F.xxhash64(by)


def judge_quality(
    docs: DataFrame,
    max_docs: int = 10,
    max_share: float = 0.5,
    min_left: float = 0.5,
    min_words: int = 50,
    max_repeated: float = 0.5,
    host: str | None = "source",
    id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """``doc_id, text_key``, the counts, ``base_failed``, ``lost_words``, ``lost_lines`` and ``kept`` for
    every row of ``docs``.

    ``lost_lines`` are the places (from 0) of the frequent lines of the text, in order, ``lost_words`` the
    words in them. A row fails the base rules if it has fewer than ``min_words`` words, or if more than
    ``max_repeated`` of them stand in a window of three words that the text holds twice. ``kept`` rows passed
    them and have ``min_left`` of their words outside of frequent lines.

    - Null and empty texts have no words and no lines: they fail. Lines without a word are not counted.
    - Rows without a host are one host together; ``host`` None takes all rows as one.
    - Rows that repeat are one document and get the same result, as do texts of one id with the same line.
      Rows without id are documents by their text.
    - Other columns are not looked at. An empty table gives an empty table.
    """
    key, row_key, by = _named(docs, id, text, host)
    kinds = "doc_id long, text_key long, host long, " + ", ".join(f"{name} long" for name in COUNTS)
    rows = docs.select(
        key.alias("doc_id"), row_key.alias("text_key"), by.alias("host"), F.col(f"`{text}`").alias("body")
    )
    rows = stored(rows.mapInArrow(_measure, f"{kinds}, lines {_LINES}"), "measures")
    lines = rows.select(*DOC, "host", F.explode("lines").alias("l")).select(*DOC, "host", "l.*")
    frequent = stored(_frequent(rows, lines, max_docs, max_share), "frequent-lines")
    lost = (
        lines.join(measured(frequent), ["host", "line"], "left_semi")
        # Rows that repeat count once.
        .groupBy(*DOC, "line")
        .agg(F.first("words").alias("words"), F.first("places").alias("places"))
        .groupBy(*DOC)
        .agg(
            F.sum("words").alias("lost_words"),
            F.array_sort(F.flatten(F.collect_list("places"))).alias("lost_lines"),
        )
    )
    judged = join(rows.drop("host", "lines"), stored(lost, "lost-lines"), DOC, "left")
    failed = (F.col("n_words") < min_words) | (F.col("n_repeat_words") > max_repeated * F.col("n_words"))
    left = F.col("n_words") - F.col("lost_words")
    return judged.select(
        *DOC,
        *COUNTS,
        failed.alias("base_failed"),
        F.coalesce("lost_words", F.lit(0)).alias("lost_words"),
        F.coalesce("lost_lines", F.array().cast("array<int>")).alias("lost_lines"),
        (~failed & F.coalesce(left >= min_left * F.col("n_words"), F.lit(True))).alias("kept"),
    )


def _frequent(rows: DataFrame, lines: DataFrame, max_docs: int, max_share: float) -> DataFrame:
    """``host, line`` of the lines that too many documents of their host hold. A document is an id; without
    one, a text."""
    own = F.when(F.col("doc_id").isNull(), F.col("text_key")).otherwise(0).alias("own")
    held = (
        lines.select("host", "line", "doc_id", own)
        .distinct()
        .groupBy("host", "line")
        .agg(F.count(F.lit(1)).alias("n"))
        .filter(F.col("n") >= min(3, max_docs + 1))
    )
    sizes = rows.select("host", "doc_id", own).distinct().groupBy("host").agg(F.count(F.lit(1)).alias("docs"))
    limit = (F.col("n") > max_docs) | ((F.col("n") >= 3) & (F.col("n") > max_share * F.col("docs")))
    return held.join(measured(stored(sizes, "hosts")), "host").filter(limit).select("host", "line")


def clean_texts(
    docs: DataFrame, judged: DataFrame, host: str | None = "source", id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """The kept rows of ``docs``, their texts without the lost lines; other columns stay as they are.

    ``judged`` is the result of ``judge_quality`` for these rows.
    """
    key, row_key, _ = _named(docs, id, text, host)
    own, own_key, lost = (unused(docs, name) for name in ("row_id", "row_key", "lost_lines"))
    kept = judged.filter("kept").select(
        F.col("doc_id").alias("id_"), F.col("text_key").alias("key_"), F.col("lost_lines").alias(lost)
    )
    kept = kept.dropDuplicates(["id_", "key_"])
    marked = docs.withColumns({own: key, own_key: row_key})
    same = F.col(own).eqNullSafe(F.col("id_")) & (F.col(own_key) == F.col("key_"))
    joined = marked.join(kept, same)
    lines = F.split(F.col(f"`{text}`"), "\n", -1)
    places = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col(lost))
    left = F.array_join(F.transform(places, lambda i: F.get(lines, i)), "\n")
    cut = F.when(F.size(lost) > 0, left).otherwise(F.col(f"`{text}`"))
    return joined.withColumn(text, cut).select(*[F.col(f"`{name}`") for name in docs.columns])
