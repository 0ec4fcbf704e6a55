import random

import pytest

import wearlog.llm.mixing as mixing
import wearlog.llm.rows as rows_module
from brute import mix


def _rows(df):
    rows = [(r["doc_id"], r["size"], r["source_size"], r["target"], r["taken"]) for r in df.collect()]
    return sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, *r[1:]))


def test_equals_the_plain_version(documents, corpus):
    expected = mix([(i, source, text) for i, text, _, source in corpus])
    got = _rows(mixing.mix_sources(documents))
    assert got == sorted((row[0], *own) for row, own in zip(corpus, expected))
    # Whatever the partitions.
    assert _rows(mixing.mix_sources(documents.repartition(3, "doc_id"))) == got


@pytest.mark.parametrize("most", [100_000, -1])
def test_targets_are_met_and_caps_hold(spark, monkeypatch, most):
    monkeypatch.setattr(rows_module, "MOST_BROADCAST_BYTES", most)
    rng = random.Random(5)
    rows = [
        (i, rng.choice(["hot"] * 6 + ["b", "c", "d", "e", None]), "w " * rng.randint(0, 30))
        for i in range(3000)
    ]
    got = mixing.mix_sources(spark.createDataFrame(rows, "doc_id long, source string, text string"))
    sums = {}
    for r in got.collect():
        assert 0 <= r["taken"] <= 2 * r["size"]
        own = sums.setdefault(r["source"], [0, r["target"], r["source_size"]])
        own[0] += r["taken"]
    for taken, target, size in sums.values():
        assert taken == int(target + 0.5) and target <= 2 * size
    total = sum(size for _, _, size in sums.values())
    assert sum(target for _, target, _ in sums.values()) == pytest.approx(1.5 * total)


def test_weights_that_cannot_be_met_end_at_the_caps(documents, spark):
    weights = spark.createDataFrame([("s1", 1.0), (None, 3.0), ("s2", 0.0)], "source string, w double")
    rows = mixing.mix_sources(documents, weights, share=1.5, max_epochs=2).collect()
    for r in rows:
        named = r["source"] in ("s1", None)
        assert r["target"] == (2.0 * r["source_size"] if named else 0.0)
        assert r["taken"] == (2 * r["size"] if named else 0)


def test_a_source_per_host_is_numbered_and_filled_in_ranges(spark, monkeypatch):
    monkeypatch.setattr(mixing, "ROWS_PER_TASK", 40)
    rng = random.Random(9)
    hosts = [f"host{i:04d}" for i in range(500)] + ["\U0001F600", "\uFFFD", "", None]
    # Sizes over many magnitudes, so that many sources are clamped; some agree.
    docs = [(i, host, "w " * int(2 ** rng.uniform(0, 9))) for i, host in enumerate(hosts * 2)]
    table = spark.createDataFrame(docs, "doc_id long, source string, text string").repartition(5)
    expected = sorted((row[0], *own) for row, own in zip(docs, mix(docs)))
    got = _rows(mixing.mix_sources(table))
    assert [r[:3] + r[4:] for r in got] == [r[:3] + r[4:] for r in expected]
    assert [r[3] for r in got] == pytest.approx([r[3] for r in expected])


def test_awkward_rows(awkward):
    rows = awkward.collect()
    expected = mix([(r["doc_id"], r["source"], r["text"]) for r in rows])
    expected = [(r["doc_id"], *own) for r, own in zip(rows, expected)]
    key = lambda r: (r[0] is None, r[0] or 0, *r[1:])
    assert _rows(mixing.mix_sources(awkward)) == sorted(expected, key=key)
    assert mixing.mix_sources(awkward.limit(0)).collect() == []
    nothing = mixing.mix_sources(awkward.filter("text is null")).collect()
    assert {(r["size"], r["target"], r["taken"]) for r in nothing} == {(0, 0.0, 0)}


def test_runs_no_python(documents):
    plan = mixing.mix_sources(documents)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
