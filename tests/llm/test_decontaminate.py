import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

import wearlog.llm.rows as helpers
from brute import contamination, words
from wearlog.llm.decontaminate import (
    find_contamination,
    planned,
    proximity_matches,
    store_postings,
    windows_of,
)


@pytest.fixture()
def items(spark, corpus, prose):
    rng = random.Random(2)
    first = corpus[12][1]
    rows = [
        (1, first),
        (2, " ".join(words(corpus[20][1])[5:18]).upper()),
        (10, prose(rng, "en", 40)),
        (3, "the of"),
        (4, "ing"),
        (5, None),
        (6, " ?"),
        (None, first),
        (7, "word never seen"),
        (1, "the of"),
    ]
    return spark.createDataFrame(rows, "item_id long, text string")


def _expected(docs, items, n):
    return contamination(
        [text for _, text in docs],
        [(r["item_id"], r["text"]) for r in items.collect() if r["item_id"] is not None],
        n,
    )


def _key(row):
    return (row[0] is None, row[0] or 0, *row[1:])


@pytest.mark.parametrize("most", [100_000, -1])
def test_equals_the_plain_version(documents, corpus, items, monkeypatch, most):
    monkeypatch.setattr(helpers, "MOST_BROADCAST_BYTES", most)
    docs = [(row[0], row[1]) for row in corpus]
    expected = _expected(docs, items, 10)
    assert sum(hit > 0 for _, hit, _ in expected) > 3
    got = find_contamination(documents, items).collect()
    rows = [(r["doc_id"], r["n_words"], r["n_hit"], r["item_ids"]) for r in got]
    assert sorted(rows) == sorted((i, *own) for (i, _), own in zip(docs, expected))
    assert all(r["n_items"] == len(r["item_ids"]) for r in got)


def test_awkward_rows(spark, awkward):
    items = spark.createDataFrame(
        [(1, "very LONG line"), (2, "x"), (None, "other")], "item_id long, text string"
    )
    rows = [(r["doc_id"], r["text"]) for r in awkward.collect()]
    expected = [(i, *own) for (i, _), own in zip(rows, _expected(rows, items, 10))]
    got = [
        (r["doc_id"], r["n_words"], r["n_hit"], r["item_ids"])
        for r in find_contamination(awkward, items).collect()
    ]
    assert sorted(got, key=_key) == sorted(expected, key=_key)
    assert find_contamination(awkward.limit(0), items).collect() == []
    none = find_contamination(awkward, items.limit(0)).collect()
    assert len(none) == awkward.count() and {r["n_hit"] for r in none} == {0}


@pytest.mark.parametrize("most", [10_000_000, -1])
def test_a_window_that_all_items_share(spark, monkeypatch, most):
    monkeypatch.setattr(helpers, "MOST_BROADCAST_BYTES", most)
    items = [(i, f"the same few words w{i}") for i in range(300)] + [(i, "one two") for i in range(300, 400)]
    docs = [(i, f"x the same few words w{i % 3} one two") for i in range(40)] + [(40, "the same"), (41, "two one")]
    table = spark.createDataFrame(items, "item_id long, text string")
    got = find_contamination(spark.createDataFrame(docs, "doc_id long, text string"), table, n=4).collect()
    expected = _expected(docs, table, 4)
    assert sorted((r["doc_id"], r["n_words"], r["n_hit"], r["item_ids"]) for r in got) == sorted(
        (i, *own) for (i, _), own in zip(docs, expected)
    )
    assert max(r["n_items"] for r in got) == 400


def test_lists_count_as_long_as_they_are(spark):
    short = spark.range(3).selectExpr("id", "'x' AS name")
    assert short.agg(F.sum(helpers.row_bytes(short))).first()[0] == 3 * (16 + 8 + 17)
    wide = spark.range(1).selectExpr("transform(sequence(1, 1000), i -> 'twelve bytes') AS list")
    assert wide.agg(F.sum(helpers.row_bytes(wide))).first()[0] > 12_000


def test_proximity(spark):
    docs = spark.createDataFrame(
        [
            (1, "x alpha beta gamma"),
            (2, "x alpha y beta gamma"),
            (3, "alpha y y y beta gamma"),
            (4, "gamma beta alpha"),
        ],
        "doc_id long, text string",
    )
    items = spark.createDataFrame([(1, "alpha beta gamma")], "item_id long, text string")
    windows = windows_of(items, 10)
    windows = windows.select("phrase").distinct()
    terms = windows.select(F.explode("phrase").alias("term")).distinct()
    postings = store_postings(docs, terms, "doc_id", "text")
    near = lambda slop: {
        r["doc_id"] for r in proximity_matches(planned(windows, postings), postings, slop).collect()
    }
    assert near(0) == {1} and near(1) == near(2) == {1, 2}
    assert near(3) == {1, 2, 3} and near(4) == {1, 2, 3, 4}


def test_runs_no_python(documents, items):
    plan = find_contamination(documents, items)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


@pytest.mark.parametrize("slop", [0, 1, 2])
def test_near_places_equal_the_plain_version(spark, slop):
    rng = random.Random(7)
    text = lambda n: " ".join(rng.choice("abcdefghij") * 2 for _ in range(n))
    docs = [(i, text(rng.choice([3, 20, 60]))) for i in range(30)] + [(None, text(30)), (2, None), (5, "")]
    items = [(i, text(rng.choice([1, 2, 3, 5, 7]))) for i in range(12)]
    windows = {tuple(w[i : i + 4]) for _, t in items for w in [words(t)] for i in range(max(1, len(w) - 3))}
    counts = Counter(w for _, t in docs for w in words(t))
    expected = Counter()
    for name, (i, t) in enumerate(docs):
        own = words(t)
        for window in windows:
            if any(w not in counts for w in window):
                continue
            rarest = min(range(len(window)), key=lambda o: (counts[window[o]], o))
            for start in (p - rarest for p, w in enumerate(own) if w == window[rarest] and p >= rarest):
                close = all(
                    window[o] in own[max(0, start + o - slop) : start + o + slop + 1] for o in range(len(window))
                )
                expected[name] += close and tuple(own[start : start + len(window)]) != window
    found = find_contamination(
        spark.createDataFrame(docs, "doc_id long, text string").repartition(3),
        spark.createDataFrame(items, "item_id long, text string"), n=4, slop=slop,
    )
    got = Counter((r["doc_id"], r["n_words"], r["n_near"]) for r in found.collect())
    assert got == Counter((i, len(words(t)), expected[name]) for name, (i, t) in enumerate(docs))
    assert (sum(expected.values()) > 20) == (slop > 0)
