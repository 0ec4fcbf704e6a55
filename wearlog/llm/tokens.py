"""Token counts (operator 6): offset-mapped attribution.

The fields of a record are joined by line breaks and encoded once, as one document, so that the total is
what a model would see. Each token's bytes are mapped to characters, and its character span is
interval-joined to the sections: the lines of each field, a line break belonging to the line it ends.

Rule for tokens that cross a boundary: the section with most of the token's characters gets it whole, the
earlier one of equals. A token that covers part of a character counts as covering it. Counts of sections
therefore sum up to the total.
"""

import base64

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wearlog.llm.rows import scan, unused

# Fixed value: the pattern that splits text before the merges of the vocabulary.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def read_ranks(spark: SparkSession, path: str) -> bytes:
    """The vocabulary file (a few MB), from any store that Spark reads."""
    return bytes(spark.read.format("binaryFile").load(path).select("content").first()["content"])


class Encoder:
    """A byte-level vocabulary: lines of a base64 token and its rank."""

    def __init__(self, ranks: bytes, pattern: str = PATTERN):
        pairs = (line.split() for line in ranks.splitlines() if line.strip())
        known = {base64.b64decode(token): int(rank) for token, rank in pairs}
        self.encoding = tiktoken.Encoding(
            "vocabulary", pat_str=pattern, mergeable_ranks=known, special_tokens={}
        )
        self.sizes = np.zeros(max(known.values()) + 1, np.int64)
        for token, rank in known.items():
            self.sizes[rank] = len(token)

    def spans(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """First and end character of each token."""
        tokens = self.encoding.encode_to_numpy(text, disallowed_special=())
        ends = np.cumsum(self.sizes[tokens])
        starts = ends - self.sizes[tokens]
        data = np.frombuffer(text.encode("utf-8", "replace"), np.uint8)
        opens = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
        # A token that starts within a character covers that one too.
        return opens[np.minimum(starts + 1, len(data))] - 1, opens[ends]


def attribute(starts: np.ndarray, ends: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, int]:
    """The section of each token and the number of tokens that cross a boundary.

    ``bounds``: where sections begin, ascending, the first 0; empty sections get nothing.
    """
    first = np.searchsorted(bounds, starts, "right") - 1
    last = np.searchsorted(bounds, ends - 1, "right") - 1
    crossing = np.flatnonzero(last > first)
    if len(crossing):
        n = (last - first + 1)[crossing]
        token = np.repeat(crossing, n)
        opens = np.concatenate([[0], np.cumsum(n)])[:-1]
        section = first[token] + np.arange(len(token)) - np.repeat(opens, n)
        high = np.append(bounds, np.iinfo(np.int64).max)[section + 1]
        shared = np.minimum(ends[token], high) - np.maximum(starts[token], bounds[section])
        order = np.lexsort((section, -shared, token))
        first[crossing] = section[order[opens]]
    return first, len(crossing)


SECTION = "struct<field:string,line:long,start:long,end:long,n_tokens:long>"


def attribute_tokens(
    docs: DataFrame,
    vocabulary: str,
    keep: list[str],
    fields: list[str],
    pattern: str = PATTERN,
) -> DataFrame:
    """The columns ``keep`` with ``n_tokens``, ``n_crossing`` and ``sections`` of every row: field, line
    (from 0), first and end character in the joined document, and tokens.

    - ``vocabulary``: path of a rank file. Null fields are empty. An empty field is one empty line; every
      field but the last ends with the line break that joins it to the next.
    - Repeated rows get the same result; texts of any length are encoded as a whole.
    - An empty table gives an empty table; kept columns may have any names (see ``rows.scan``).
    """
    spark = docs.sparkSession
    ranks = spark.sparkContext.broadcast(read_ranks(spark, vocabulary))
    parts = [F.coalesce(F.col(f"`{name}`").cast("string"), F.lit("")) for name in fields]
    encoders: list[Encoder] = []

    def work(part: pa.RecordBatch) -> list[pa.Array]:
        if not encoders:
            encoders.append(Encoder(ranks.value, pattern))
        totals, crossings, lists = [], [], []
        sizes = part.column(part.num_columns - 2).to_pylist()
        bodies = part.column(part.num_columns - 1).cast(pa.binary()).to_pylist()
        for lengths, data in zip(sizes, bodies):
            stops = np.cumsum(np.array(lengths) + 1) - 1
            values = [data[b - n : b].decode("utf-8", "replace") for n, b in zip(lengths, stops)]
            text = "\n".join(values)
            bounds, owners, lines = _sections(text, [len(value) for value in values])
            starts, ends = encoders[0].spans(text)
            section, crossing = attribute(starts, ends, bounds)
            counts = np.bincount(section, minlength=len(bounds))
            stops = np.append(bounds[1:], len(text))
            totals.append(len(starts))
            crossings.append(crossing)
            lists.append(
                [
                    {"field": fields[f], "line": i, "start": a, "end": b, "n_tokens": n}
                    for f, i, a, b, n in zip(
                        owners, lines, bounds.tolist(), stops.tolist(), counts.tolist()
                    )
                ]
            )
        kind = pa.list_(
            pa.struct(
                [("field", pa.string())]
                + [(name, pa.int64()) for name in ("line", "start", "end", "n_tokens")]
            )
        )
        return [pa.array(totals, pa.int64()), pa.array(crossings, pa.int64()), pa.array(lists, kind)]

    joined = F.concat_ws("\n", *parts)
    lengths = F.array(*[F.octet_length(part) for part in parts])
    extra = unused(docs, "field_bytes")
    out = scan(
        docs.withColumn(extra, lengths),
        [*keep, extra],
        joined,
        work,
        f"n_tokens long; n_crossing long; sections array<{SECTION}>",
        prefix="found_",
    )
    return out.drop(extra)


def _sections(text: str, lengths: list[int]) -> tuple[np.ndarray, list[int], list[int]]:
    """Where the sections begin, the field of each and its line within the field."""
    bounds, owners, lines = [], [], []
    start = 0
    for f, length in enumerate(lengths):
        stop = start + length
        line, at = 0, start
        while True:
            bounds.append(at)
            owners.append(f)
            lines.append(line)
            at = text.find("\n", at, stop) + 1
            if at == 0:
                break
            line += 1
        start = stop + 1
    return np.array(bounds, np.int64), owners, lines
