import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from wearlog.llm.queries import VOCABULARY
from wearlog.llm.tokens import Encoder, attribute, attribute_tokens


@pytest.fixture(scope="module")
def encoder():
    with open(VOCABULARY, "rb") as file:
        return Encoder(file.read())


def _plain(starts, ends, bounds):
    """Section by the most shared characters, the earlier of equals."""
    stops = [*bounds[1:], 10**9]
    shared = lambda a, b, k: min(b, stops[k]) - max(a, bounds[k])
    return [
        max(range(len(bounds)), key=lambda k: (shared(a, b, k), -k)) for a, b in zip(starts, ends)
    ]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 6), max_size=12), st.lists(st.integers(1, 7), max_size=8))
def test_tokens_go_to_the_section_with_most_of_them(sizes, gaps):
    ends = np.cumsum(sizes) if sizes else np.zeros(0, int)
    starts = ends - np.array(sizes, int)
    bounds = np.concatenate([[0], np.cumsum(gaps)]).astype(int)
    section, crossing = attribute(starts, ends, bounds)
    assert section.tolist() == _plain(starts.tolist(), ends.tolist(), bounds.tolist())
    cuts = sum(any(a < c < b for c in bounds.tolist()) for a, b in zip(starts, ends))
    assert crossing == cuts


@settings(max_examples=100, deadline=None)
@given(st.text(alphabet="ab é日😀\n\t ß", max_size=40))
def test_spans_cover_the_text(encoder, text):
    starts, ends = encoder.spans(text)
    tokens = encoder.encoding.encode_ordinary(text)
    assert len(starts) == len(tokens)
    if tokens:
        assert starts[0] == 0 and ends[-1] == len(text)
        # Neighbours meet, or share a character that both have bytes of.
        assert set((ends[:-1] - starts[1:]).tolist()) <= {0, 1}
    for token, a, b in zip(tokens, starts, ends):
        piece = encoder.encoding.decode_single_token_bytes(token)
        assert piece in text[a:b].encode()


def test_counts_by_field_and_line(spark, corpus, encoder):
    rows = [(i, f"title\n{i}", t) for i, t, _, _ in corpus]
    docs = spark.createDataFrame(rows, "doc_id long, title string, text string").repartition(3)
    found = attribute_tokens(docs, VOCABULARY, ["doc_id"], ["title", "text"]).collect()
    texts = {i: (title, t or "") for i, title, t in rows}
    for r in found:
        whole = "\n".join(texts[r["doc_id"]])
        assert r["n_tokens"] == len(encoder.encoding.encode_ordinary(whole))
        assert sum(s["n_tokens"] for s in r["sections"]) == r["n_tokens"]
        pieces = [whole[s["start"] : s["end"]] for s in r["sections"]]
        assert "".join(pieces) == whole
        for field, value in zip(("title", "text"), texts[r["doc_id"]]):
            own = [p for s, p in zip(r["sections"], pieces) if s["field"] == field]
            assert [p.rstrip("\n") if "\n" in p else p for p in own] == [
                line for line in value.split("\n")
            ]
        starts, ends = encoder.spans(whole)
        bounds = [s["start"] for s in r["sections"]]
        counts = np.bincount(_plain(starts, ends, bounds), minlength=len(bounds)).tolist()
        assert [s["n_tokens"] for s in r["sections"]] == counts


def test_awkward_rows(spark, awkward):
    keep = [*awkward.columns, "field_bytes"]
    docs = awkward.selectExpr("*", "1 as field_bytes")
    found = attribute_tokens(docs, VOCABULARY, keep, ["source", "text"])
    assert found.columns[: len(keep)] == keep and len(found.collect()) == awkward.count()
    assert attribute_tokens(awkward.limit(0), VOCABULARY, ["doc_id"], ["text"]).collect() == []
    long = spark.createDataFrame([(1, "a" * 300_000), (2, None)], "doc_id long, text string")
    rows = {r["doc_id"]: r for r in attribute_tokens(long, VOCABULARY, ["doc_id"], ["text"]).collect()}
    assert rows[1]["n_tokens"] > 0 and rows[2]["n_tokens"] == 0
    assert [s.asDict() for s in rows[2]["sections"]] == [
        {"field": "text", "line": 0, "start": 0, "end": 0, "n_tokens": 0}
    ]
