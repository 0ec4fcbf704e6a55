import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

import wearlog.llm.flat as flat
import wearlog.llm.rows as rows
from brute import quality
from wearlog.llm.quality import COUNTS, clean_texts, judge_quality

FIELDS = [*COUNTS, "base_failed", "lost_words", "lost_lines", "kept"]


def _judged(docs, **options):
    found = judge_quality(docs, **options).collect()
    return sorted(((r["doc_id"], *(r[name] for name in FIELDS)) for r in found), key=repr)


def _plain(rows, **options):
    return sorted(((r[0], *own) for r, own in zip(rows, quality(rows, **options))), key=repr)


@pytest.mark.parametrize("limit", [1, 2, 10])
@pytest.mark.parametrize("small", [False, True])
def test_equals_brute_force(spark, corpus, monkeypatch, limit, small):
    if small:
        # Slices of one row, and no broadcast.
        monkeypatch.setattr(flat.slices, "__defaults__", (64,))
        monkeypatch.setattr(rows.measured, "__defaults__", (0,))
    rows_ = [(i, text, source) for i, text, _, source in corpus]
    docs = spark.createDataFrame(rows_, "doc_id long, text string, source string").repartition(3)
    assert _judged(docs, max_docs=limit) == _plain(rows_, max_docs=limit)


texts = st.lists(st.sampled_from(["a", "B", "b", " ", "  ", "\n", "7", "8", "ä", "#", "\x85", "x y z "]), max_size=30)


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 6)), texts.map("".join), st.sampled_from(["h", None])), max_size=9))
def test_any_text(spark, docs):
    frame = spark.createDataFrame(docs, "doc_id long, text string, source string")
    assert _judged(frame, max_docs=2) == _plain(docs, max_docs=2)


def test_awkward_rows(spark, awkward):
    names = awkward.columns
    plain = [(r["doc_id"], r["text"], r["source"]) for r in awkward.collect()]
    assert _judged(awkward, max_docs=2) == _plain(plain, max_docs=2)
    judged = judge_quality(awkward, max_docs=2, min_words=1)
    cleaned = clean_texts(awkward, judged)
    assert cleaned.columns == names and cleaned.dtypes == awkward.dtypes
    # Of the null ids with the long line, nothing but that line is left to lose.
    assert {r["doc_id"] for r in cleaned.collect()} <= {r["doc_id"] for r in awkward.collect()}
    assert judge_quality(awkward.limit(0)).collect() == []


def test_depleted_documents_go_and_others_lose_the_lines(spark):
    rng = random.Random(4)
    own = lambda n: " ".join(str(rng.choice("pqrstuvw")) + chr(97 + rng.randrange(26)) + chr(97 + rng.randrange(26)) for _ in range(n))
    menu = "Home  About 12 contact " + own(30)
    docs = [(i, f"{menu.replace('12', str(i + 10))}\n{own(60)}", "a") for i in range(12)]
    docs += [(20 + i, f"{own(25)}\n\t{menu.upper() if i else menu}\n{menu}", "a") for i in range(2)]
    docs += [(30, f"{own(20)}\n{menu}\n{menu}", "b"), (31, f"{own(70)}\n{menu}", "b")]
    frame = spark.createDataFrame(docs, "doc_id long, text string, source string")
    judged = judge_quality(frame, max_docs=10, max_repeated=1.0)
    rows_ = {r["doc_id"]: r for r in judged.collect()}
    assert [i for i, r in rows_.items() if not r["kept"]] == [20, 21]
    assert rows_[21]["lost_lines"] == [1, 2] and rows_[30]["lost_lines"] == rows_[31]["lost_lines"] == []
    texts = {r["doc_id"]: r["text"] for r in clean_texts(frame, judged).collect()}
    assert set(texts) == {*range(12), 30, 31}
    assert all(texts[i] == docs[i][1].split("\n")[1] for i in range(12)) and texts[31] == docs[-1][1]


def test_a_line_of_a_third_of_all_rows_is_combined_before_it_is_counted(spark):
    docs = spark.range(30000).selectExpr(
        "id AS doc_id",
        "concat('line of many\n', translate(id, '0123456789', 'abcdefghij'), ' words of its own') AS text",
        "'h' AS source",
    )
    judged = judge_quality(docs, min_words=1)
    assert judged.filter("lost_words = 3 AND kept").count() == 30000
