import random
import re

import pytest

import corpus_pipeline
from brute import contamination, line_dedup, mix, near_classes, words
from wearlog.llm.rows import BATCH_BYTES

NAMES = [name for name, _ in corpus_pipeline.STAGES]


@pytest.fixture()
def tables(spark, corpus, prose, tmp_path):
    """A folder with documents and a benchmark that two of them quote."""
    quoted = " ".join(words(corpus[21][1])[3:20])
    junk = [(900 + i, t, None, "s1") for i, t in enumerate(["12 34 !!", "", None, "日本語の文章です。" * 40])]
    rows = [*corpus, (899, f"before {quoted} after", "en", "s2"), *junk]
    rows = [(*row, len(row[1]) if row[1] is not None else None) for row in rows]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(rows, schema).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    items = [(1, quoted), (2, prose(random.Random(77), "de", 30))]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    return str(tmp_path), rows, items


def _plain(rows, items):
    """All stages but the rejection of other languages, which is given."""
    rows = [r for r in rows if r[1] and re.search(r"[^\W\d_]", r[1]) and "日本" not in r[1]]
    kept = line_dedup([(r[0], r[1]) for r in rows])
    rows = [(r[0], own[2], *r[2:4], len(own[2])) for r, own in zip(rows, kept)]
    rows.sort()
    groups = near_classes([r[1] for r in rows])
    rows = [r for i, r in enumerate(rows) if groups[i] == i]
    hits = contamination([r[1] for r in rows], items)
    rows = [r for r, (_, hit, _) in zip(rows, hits) if not hit]
    return rows, [(r[0], *own) for r, own in zip(rows, mix([(r[0], r[3], r[1]) for r in rows]))]


def test_equals_the_plain_version(spark, tables):
    folder, rows, items = tables
    clean, expected = _plain(rows, items)
    got = corpus_pipeline.run(spark, folder).collect()
    assert sorted(r["doc_id"] for r in got) == [row[0] for row in expected]
    assert sorted((r["doc_id"], r["size"], r["source_size"], r["target"], r["taken"]) for r in got) == expected
    assert len(expected) < len(rows) - 20


def test_stages_keep_the_columns_and_take_effect(spark, tables):
    folder, rows, _ = tables
    docs = spark.read.parquet(f"{folder}/documents.parquet").selectExpr("*", "doc_id as row_id", "1.5 as text_key")
    counts = [docs.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, folder).cache()
        assert out.dtypes == docs.dtypes
        counts.append(out.count())
        docs = out
    assert counts[1] == counts[0] - 7 and counts[2] == counts[1] > counts[3] > counts[4]
    assert docs.filter("n_chars <> length(text)").isEmpty()


@pytest.mark.parametrize("name", NAMES)
def test_awkward_rows(spark, awkward, tables, name):
    folder, _, _ = tables
    stage = dict(corpus_pipeline.STAGES)[name]
    docs = awkward.withColumn("n_chars", awkward["doc_id"].cast("int"))
    found = stage(spark, docs, folder).collect()
    assert stage(spark, docs.limit(0), folder).collect() == []
    left = sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in found)
    whole = sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in docs.collect())
    if name == "language_id":
        # Rows without a letter go.
        assert left == [(False, i) for i in (1, 1, 2, 6)] + [(True, 0)] * 2
    elif name == "near_dedup":
        # The two rows of id 1 and two of those without id are one class; rows without words stay.
        assert left == [(False, i) for i in (1, 2, 3, 3, 4, 5, 6)] + [(True, 0)]
    else:
        assert left == whole


def test_near_dedup_keeps_the_smallest_of_each_class(spark, prose):
    rng = random.Random(2)
    text = prose(rng, "en", 100)
    rows = [(i, text if i % 2 else f"{text} more") for i in range(5, 40)]
    rows += [(100 + i, prose(rng, "de", 50)) for i in range(10)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = dict(corpus_pipeline.STAGES)["near_dedup"](spark, docs, "")
    assert sorted(r["doc_id"] for r in kept.collect()) == [5, *range(100, 110)]


def test_clean_documents_stay(spark, prose, tables):
    folder, _, _ = tables
    rng = random.Random(31)
    rows = [(i, prose(rng, ("en", "de", "fr")[i % 3], 60), ("en", "de", "fr")[i % 3], "s", 0) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, folder)
    assert docs.count() == 60


@pytest.mark.parametrize("labelled", [None, ""])
def test_without_a_learned_language_documents_with_letters_stay(spark, prose, labelled):
    rng = random.Random(5)
    rows = [(i, prose(rng, ("en", "de")[i % 2], 40), None) for i in range(20)]
    rows += [(20, "Ünd", None), (21, "12 ?!", None), (22, "", "en"), (23, labelled, "en"), (24, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    kept = dict(corpus_pipeline.STAGES)["language_id"](spark, docs, "")
    assert sorted(map(tuple, kept.collect())) == rows[:21]


@pytest.mark.parametrize("name", ["language_id", "line_dedup", "near_dedup"])
def test_python_gets_batches_of_few_bytes(spark, prose, monkeypatch, name):
    rng, key = random.Random(9), "spark.sql.execution.arrow.maxBytesPerBatch"
    rows = [(i, prose(rng, "en", 300), "en") for i in range(60)]
    longest = max(len(row[1]) for row in rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    docs = docs.crossJoin(spark.range(50).withColumnRenamed("id", "n")).repartition(1)
    docs = docs.selectExpr("doc_id * 50 + n as doc_id", "concat(text, n) as text", "lang").cache()
    too_large = spark.sparkContext.accumulator(0)
    asked = type(docs).mapInArrow

    def noted(self, func, schema):
        def run(batches):
            def each():
                for batch in batches:
                    too_large.add(int(batch.nbytes > BATCH_BYTES + 2 * longest))
                    yield batch

            yield from func(each())

        return asked(self, run, schema)

    before = spark.conf.get(key, None)
    spark.conf.unset(key)
    monkeypatch.setattr(type(docs), "mapInArrow", noted)
    try:
        dict(corpus_pipeline.STAGES)[name](spark, docs, "").collect()
        assert too_large.value == 0
        # A limit that the session has stays.
        spark.conf.set(key, "64m")
        dict(corpus_pipeline.STAGES)[name](spark, docs, "").collect()
        assert too_large.value > 0 and spark.conf.get(key) == "64m"
    finally:
        docs.unpersist()
        spark.conf.unset(key)
        if before is not None:
            spark.conf.set(key, before)


def test_the_order_of_the_stages():
    assert NAMES == ["language_id", "line_dedup", "near_dedup", "decontaminate", "mix_sources"]
