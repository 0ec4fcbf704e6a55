import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

import wearlog.llm.near_dup as near_dup
from brute import near_classes, probability_jaccard, roots, shingle_counts
from wearlog.llm.components import components
from wearlog.llm.flat import Words, flat_text
from wearlog.llm.near_dup import near_duplicates, shingles, signatures


def _sets(texts):
    elements, counts, first = shingles(Words(*flat_text(pa.array(texts, pa.string()))))
    return [(elements[a:b], counts[a:b]) for a, b in zip(first[:-1], first[1:])]


def _edited(rng, words, n):
    words = list(words)
    for _ in range(n):
        words[rng.randrange(len(words))] = f"edit{rng.randrange(10**6)}"
    return " ".join(words)


@pytest.fixture(scope="module")
def copies(prose):
    """Texts with copies, near copies of one text in number, and chains of near copies."""
    rng = random.Random(12)
    texts = [prose(rng, ("en", "de")[i % 2], rng.choice([2, 4, 30, 120])) for i in range(60)]
    base = prose(rng, "en", 90).split(" ")
    texts += [_edited(rng, base, rng.randint(0, 3)) for _ in range(60)]
    chain = prose(rng, "fr", 150).split(" ")
    for _ in range(10):
        chain = _edited(rng, chain, 2).split(" ")
        texts.append(" ".join(chain))
    texts += [texts[0].upper(), texts[2] + "!", "one two", "One TWO", "same " * 50, "same " * 49]
    texts += [None, None, "", "?!"]
    rng.shuffle(texts)
    return texts


def test_weighted_shingles_and_their_similarity(copies):
    own = _sets(copies)
    plain = [shingle_counts(text) for text in copies]
    for (elements, counts), expected in zip(own, plain):
        assert sorted(counts) == sorted(expected.values()) and len(set(elements)) == len(elements)
    rng = random.Random(1)
    for _ in range(300):
        a, b = rng.randrange(len(copies)), rng.randrange(len(copies))
        got = near_dup.probability_jaccard(*own[a], *own[b])
        assert got == pytest.approx(probability_jaccard(plain[a], plain[b]))


def test_registers_agree_with_the_similarity():
    rng = random.Random(4)
    a = Counter({i: rng.randint(1, 5) for i in range(300)})
    b = Counter({i: rng.randint(1, 5) for i in range(60, 360)})
    keys = np.concatenate([sorted(a), sorted(b)]).astype(np.uint64)
    elements = near_dup.splitmix(keys)
    weights = np.array([a[i] for i in sorted(a)] + [b[i] for i in sorted(b)])
    signed = signatures(elements, weights, np.array([0, 300, 300, 600]), 4000)
    agree = (signed[0] == signed[2]).mean()
    assert agree == pytest.approx(probability_jaccard(a, b), abs=0.03)
    assert (signed[1] == 0).all()
    # Scaled weights do not matter.
    scaled = signatures(elements[:300], weights[:300] * 1000, np.array([0, 300]), 4000)
    assert (scaled[0] == signed[0]).all()


@pytest.mark.parametrize("few, part, block", [(20_000, 256, 2048), (0, 2, 5), (0, 2, 2048)])
def test_equals_the_plain_version(spark, copies, monkeypatch, few, part, block):
    monkeypatch.setattr(near_dup, "FEW_PAIRS", few)
    monkeypatch.setattr(near_dup, "PART_PAIRS", part)
    monkeypatch.setattr(near_dup, "BLOCK_NODES", block)
    monkeypatch.setattr(near_dup, "MATCHES", 100)
    docs = spark.createDataFrame(list(enumerate(copies)), "doc_id long, text string").repartition(4)
    rows = near_duplicates(docs).collect()
    expected = near_classes(copies)
    assert {r["doc_id"]: r["class_id"] for r in rows} == dict(enumerate(expected))
    sizes = Counter(expected)
    assert all(r["class_size"] == sizes[r["class_id"]] for r in rows) and max(sizes.values()) > 30


def test_blocks_of_long_texts_are_taken_in_slices(spark, prose, monkeypatch):
    class Bounded(Words):
        """Refuses more text at a time than a slice and one row."""

        def __init__(self, text, at):
            if len(text) > (1 << 19) + 50_000:
                raise ValueError(f"{len(text)} bytes at a time")
            super().__init__(text, at)

    monkeypatch.setattr(near_dup, "Words", Bounded)
    monkeypatch.setattr(near_dup, "FEW_PAIRS", 0)
    rng = random.Random(21)
    base = prose(rng, "en", 2500).split(" ")
    # Similar texts, of which some pairs reach 0.8, and a chain.
    texts = [_edited(rng, base, rng.randint(20, 70)) for _ in range(60)]
    for _ in range(8):
        texts.append(_edited(rng, texts[-1].split(" "), 25))
    assert sum(map(len, texts)) > 2 * (1 << 19) and max(len(t.encode()) for t in texts) < 50_000
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    found = {r["doc_id"]: r["class_id"] for r in near_duplicates(docs).collect()}
    own = _sets(texts)
    similar = lambda a, b: near_dup.probability_jaccard(*own[a], *own[b]) >= 0.8
    expected = roots(len(texts), [(a, b) for a in range(len(texts)) for b in range(a) if similar(a, b)])
    assert found == dict(enumerate(expected)) and 10 < len(set(expected)) < 60


def test_awkward_rows(awkward):
    rows = near_duplicates(awkward).collect()
    assert len(rows) == awkward.count()
    copies = [r for r in rows if r["class_size"] == 4]
    # Two rows with id 1 and two without id have the same words.
    assert len(copies) == 4 and {r["class_id"] for r in copies} == {1}
    others = [r for r in rows if r["class_size"] == 1]
    assert len(others) == 7 and all(r["class_id"] == r["doc_id"] for r in others)
    assert near_duplicates(awkward.limit(0)).collect() == []


def test_components(spark):
    rng = random.Random(3)
    pairs = [(rng.randrange(300), rng.randrange(300)) for _ in range(170)]
    pairs += [(i, i + 1) for i in range(300, 360)] + [(400, i) for i in range(401, 500)]
    rng.shuffle(pairs)
    expected = roots(500, pairs)
    found = components(spark.createDataFrame(pairs, "u long, v long")).collect()
    assert {r["node"]: r["component"] for r in found} == {
        x: expected[x] for pair in pairs for x in pair if pair[0] != pair[1] or expected.count(expected[x]) > 1
    }
    assert components(spark.createDataFrame([], "u long, v long")).collect() == []
