import random

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from brute import words
from wearlog.llm.flat import Words, flat_text, range_hashes, prefix_sums, slices, word_hash
from wearlog.llm.perfect_hash import PerfectHash

texts = st.lists(st.one_of(st.none(), st.text(alphabet="aZ9 \n.é\x00日Ü{", max_size=12)), max_size=8)


@settings(max_examples=300, deadline=None)
@given(texts)
def test_words_are_those_of_the_pattern(rows):
    found = Words(*flat_text(pa.array(rows, pa.string())))
    own = [found.word(i).decode() for i in range(len(found.starts))]
    lists = [own[a:b] for a, b in zip(found.first[:-1], found.first[1:])]
    assert lists == [words(row) for row in rows]
    hashes = found.hashes.tolist()
    assert hashes == [word_hash(word) for word in own]


def test_slices_of_a_column_with_an_offset_and_nulls():
    column = pa.array(["drop", "ab", None, "c d", "", "ef"])[1:]
    text, at = flat_text(column)
    assert text.tobytes() == b"abc def" and at.tolist() == [0, 2, 2, 5, 5, 7]
    batch = pa.RecordBatch.from_arrays([column], names=["t"])
    parts = list(slices(batch, "t", limit=3))
    assert [row for part in parts for row in part.column(0).to_pylist()] == column.to_pylist()
    assert all(part.num_rows for part in parts) and len(parts) > 1


def test_equal_ranges_have_equal_hashes_wherever_they_stand():
    data = np.frombuffer(b"abcabcXabc", np.uint8)
    sums = prefix_sums(data.astype(np.uint64))
    hashes = range_hashes(sums, np.array([0, 3, 7, 0]), np.array([3, 6, 10, 4]))
    assert hashes[0] == hashes[1] == hashes[2] != hashes[3]


def test_perfect_hash_is_minimal_and_perfect():
    rng = random.Random(3)
    for n in (0, 1, 2, 500, 20_000):
        keys = np.unique(np.array([rng.getrandbits(64) for _ in range(n)], np.uint64))
        table = PerfectHash.build(keys)
        assert sorted(table.slots(keys).tolist()) == list(range(n))
        strangers = np.array([rng.getrandbits(64) for _ in range(100)], np.uint64)
        assert ((table.slots(strangers) >= -1) & (table.slots(strangers) < max(n, 1))).all()
