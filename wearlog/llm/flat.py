"""Arrow text columns as flat byte arrays: words, lines and their hashes without Python strings.

Everything works on one slice of a batch at a time (about ``SLICE_BYTES`` of text, or one longer
document), so the memory of a task does not depend on the batch.
"""

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 19
U64 = np.uint64


def splitmix(x: np.ndarray) -> np.ndarray:
    """A 64-bit mixing function, element by element."""
    with np.errstate(over="ignore"):
        x = (x + U64(0x9E3779B97F4A7C15)).astype(U64)
        x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
        return x ^ (x >> U64(31))


BASE = 0x9E3779B97F4A7C15 | 1
INVERSE = pow(BASE, -1, 1 << 64)
BYTE_CODE = splitmix(np.arange(256, dtype=U64)) | U64(1)

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

#: Of lower-cased bytes: digits, a to z and everything outside ASCII.
IS_WORD = np.zeros(256, dtype=bool)
IS_WORD[48:58] = IS_WORD[97:123] = IS_WORD[128:] = True

#: Of any bytes: all but blanks, ``[^\\x20\\x09-\\x0D]``.
NOT_BLANK = np.ones(256, dtype=bool)
NOT_BLANK[32] = NOT_BLANK[9:14] = False
AS_IT_IS = np.arange(256, dtype=np.uint8)

_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """``base ** i`` modulo 2**64 for i below n."""
    known = _powers.get(base)
    if known is None or len(known) < n:
        size = max(n, 1 << 16)
        known = np.full(size, base, dtype=U64)
        known[0] = 1
        with np.errstate(over="ignore"):
            np.multiply.accumulate(known, out=known)
        _powers[base] = known
    return known[:n]


def prefix_sums(codes: np.ndarray) -> np.ndarray:
    """Sums of ``codes[i] * BASE**i`` before each place; the hash of a range is a difference."""
    out = np.zeros(len(codes) + 1, dtype=U64)
    with np.errstate(over="ignore"):
        np.cumsum(codes * powers(BASE, len(codes)), out=out[1:])
    return out


def range_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of the ranges; equal content gives equal hashes wherever it stands."""
    with np.errstate(over="ignore"):
        # The greatest start may equal the length, so the table has one entry more.
        shifted = (sums[ends] - sums[starts]) * powers(INVERSE, len(sums))[starts]
        return splitmix(shifted + U64(BASE) * (ends - starts).astype(U64))


def flat_text(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and the n + 1 places where its values begin; null is empty."""
    if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type):
        kind = np.int64
    else:
        kind = np.int32
    _, places, data = column.buffers()
    n = len(column)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    at = np.frombuffer(places, kind)[column.offset : column.offset + n + 1].astype(np.int64)
    if data is None:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    text = np.frombuffer(data, np.uint8)[at[0] : at[-1]]
    at -= at[0]
    if column.null_count:
        # A null may cover bytes that mean nothing.
        lengths = np.where(column.is_valid().to_numpy(zero_copy_only=False), np.diff(at), 0)
        if lengths.sum() != len(text):
            keep = np.repeat(lengths > 0, np.diff(at))
            text, at = text[keep], np.concatenate([[0], np.cumsum(lengths)])
    return text, at


def column_of(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def slices(batch: pa.RecordBatch, text: str, limit: int = SLICE_BYTES):
    """Parts of a batch with about ``limit`` bytes of text each, one row at least."""
    column = column_of(batch, text)
    lengths = np.frombuffer(
        column.buffers()[1],
        np.int64 if pa.types.is_large_string(column.type) else np.int32,
    )[column.offset : column.offset + len(column) + 1].astype(np.int64) if len(column) else None
    start = 0
    while start < len(column):
        stop = int(np.searchsorted(lengths, lengths[start] + limit, "right")) - 1
        stop = min(max(stop, start + 1), len(column))
        yield batch.slice(start, stop - start)
        start = stop


class Words:
    """The words of a flat text: ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after lower-casing A-Z, or runs of
    the bytes marked in ``is_word`` after mapping each by ``fold``.

    ``starts``, ``ends``: byte ranges; ``doc``: the row of each; ``first``: n + 1 places where the
    rows' words begin; ``hashes``: 64 bits of each word.
    """

    def __init__(
        self, text: np.ndarray, at: np.ndarray, is_word: np.ndarray = IS_WORD, fold: np.ndarray = LOWER
    ):
        lowered = fold[text]
        inside = is_word[lowered]
        before = np.empty(len(text) + 1, dtype=bool)
        before[0] = False
        before[1:] = inside
        after = before[1:]
        opens = inside & ~before[:-1]
        closes = inside.copy()
        closes[:-1] &= ~after[1:]
        edges = at[1:-1]
        edges = edges[(edges > 0) & (edges < len(text))]
        opens[edges] = inside[edges]
        closes[edges - 1] = inside[edges - 1]
        self.starts = np.flatnonzero(opens)
        self.ends = np.flatnonzero(closes) + 1
        self.first = np.searchsorted(self.starts, at)
        self.lowered = lowered

    @property
    def doc(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))

    @property
    def hashes(self) -> np.ndarray:
        return range_hashes(prefix_sums(BYTE_CODE[self.lowered]), self.starts, self.ends)

    def word(self, i: int) -> bytes:
        return self.lowered[self.starts[i] : self.ends[i]].tobytes()


def word_hash(word: str) -> int:
    """The hash that ``Words`` gives to this word."""
    data = np.frombuffer(word.encode(), np.uint8)
    return int(Words(data, np.array([0, len(data)])).hashes[0])
