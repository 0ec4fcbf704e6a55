import hashlib
import random
from collections import defaultdict
from os.path import commonprefix

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

import wearlog.llm.repeats as repeats
from brute import repeats as plain
from brute import words
from wearlog.llm.passages import short_passages
from wearlog.llm.suffix_sort import common, deep_shallow
from wearlog.session import stored

strings = st.lists(
    st.builds(
        lambda n, tail: (b"abab" * 20)[:n] + tail, st.integers(0, 60), st.text("ab", max_size=4).map(str.encode)
    ),
    max_size=25,
)


@settings(max_examples=300, deadline=None)
@given(strings, st.sampled_from([1, 3, 8]), st.sampled_from([0, 4, 32]))
def test_deep_shallow_sorts(rows, chunk, shallow):
    order, lcp = deep_shallow(rows, chunk, shallow)
    got = [rows[i] for i in order]
    assert sorted(order) == list(range(len(rows))) and got == sorted(rows)
    assert lcp[1:] == [len(commonprefix(pair)) for pair in zip(got, got[1:])]


def test_common_prefix():
    assert common(b"", b"a") == 0 and common(b"ab", b"ab") == 2
    assert common(b"\x00\x00a", b"\x00\x00b") == 2 and common(b"\x00", b"\x00\x00") == 1


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.text("ab", min_size=8, max_size=14), st.integers(0, 6)), max_size=12), st.integers(0, 3), st.booleans())
def test_windows_around_an_anchor(parts, low, many):
    """Contexts: up to 6 bytes, the anchor ``XY``, up to 6 bytes; windows of 8 bytes."""
    contexts = [(t[:cut] + "XY" + t[cut:][:6]).encode() for t, cut in parts]
    lefts = [cut for _, cut in parts]
    # Above 64 contexts another way is taken.
    contexts, lefts = (contexts, lefts) if not many or not contexts else (contexts * 8, lefts * 8)
    found = repeats.repeated_windows(contexts, lefts, 2, 6, low, 6)
    for i, (c, l) in enumerate(zip(contexts, lefts)):
        windows = {
            d
            for d in range(low, min(6, l) + 1)
            if len(c) >= l - d + 8
            and any(
                j != i and m >= d and o[m - d : m - d + 8] == c[l - d : l - d + 8]
                for j, (o, m) in enumerate(zip(contexts, lefts))
            )
        }
        assert found[i] == ((min(windows), max(windows)) if windows else None)


def _texts(prose):
    rng = random.Random(6)
    passage = prose(random.Random(1), "en", 30)
    texts = [prose(rng, ("en", "de", "fr")[i % 3], rng.choice([2, 20, 60])) for i in range(60)]
    for i in range(0, 60, 3):
        at = rng.randrange(len(texts[i]))
        texts[i] = texts[i][:at] + passage + texts[i][at:]
    for i in range(12):
        own = list(passage * 2)
        for _ in range(rng.randint(0, 3)):
            own[rng.randrange(len(own))] = rng.choice("xyz")
        texts.append("".join(own))
    texts += ["ab" * 150, "b" + "ab" * 100, "zé" * 90, texts[1], texts[1], None, "", "short"]
    texts.append(texts[4] + "?" + texts[4])
    return texts


def _rows(df):
    out = []
    for r in df.collect():
        lost = sum(run["end"] - run["start"] for run in r["removed"])
        digest = hashlib.sha256(bytes(r["kept"])).hexdigest()
        out.append((r["doc_id"], len(r["kept"]) + lost, lost, len(r["removed"]), digest))
    return sorted(out, key=lambda r: (r[0] is None, r[0] or 0, *r[1:]))


@pytest.mark.parametrize("length, group", [(40, 20_000), (40, 3), (41, 2), (100, 5)])
def test_equals_the_plain_version(spark, prose, monkeypatch, length, group):
    monkeypatch.setattr(repeats, "GROUP_CONTEXTS", group)
    texts = _texts(prose)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    expected = [(i, *own) for i, own in enumerate(plain(texts, length))]
    assert 0 < sum(row[2] for row in expected) < sum(row[1] for row in expected)
    assert _rows(repeats.drop_repeats(docs, length)) == expected


def test_blocks_of_a_very_long_text(spark, prose, monkeypatch):
    monkeypatch.setattr(repeats, "SLICE_BYTES", 300)
    rng = random.Random(9)
    text = prose(rng, "en", 700)
    docs = [(1, text[:1500]), (2, text[700:2900]), (3, text[2500:])]
    found = _rows(repeats.drop_repeats(spark.createDataFrame(docs, "doc_id long, text string"), 40))
    assert found == [(i, *own) for (i, _), own in zip(docs, plain([t for _, t in docs], 40))]


def test_awkward_rows(awkward):
    rows = [(r["doc_id"], r["text"]) for r in awkward.collect()]
    expected = [(i, *own) for (i, _), own in zip(rows, plain([t for _, t in rows], 20))]
    key = lambda r: (r[0] is None, r[0] or 0, *r[1:])
    assert _rows(repeats.drop_repeats(awkward, 20)) == sorted(expected, key=key)
    assert repeats.drop_repeats(awkward.limit(0), 20).collect() == []
    with pytest.raises(ValueError):
        repeats.drop_repeats(awkward, 7)


def _passages(docs, n_words):
    """docs: (id, text); words of each row in passages of ``n_words`` that another document holds."""
    held = defaultdict(set)
    for i, text in docs:
        w = words(text)
        for at in range(len(w) - n_words + 1):
            held[tuple(w[at : at + n_words])].add((i, text))
    out = []
    for i, text in docs:
        w = words(text)
        inside = {
            p for at in range(len(w) - n_words + 1) if len(held[tuple(w[at : at + n_words])]) > 1
            for p in range(at, at + n_words)
        }
        out.append((i, len(inside)))
    return out


@pytest.mark.parametrize("n_words", [4, 11, 51])
def test_passages_equal_the_plain_version(spark, prose, n_words):
    docs = [(i, text) for i, text in enumerate(_texts(prose))] + [(3, None), (None, ""), (None, "a b " * 30)]
    docs += [docs[0], (1000, docs[0][1]), (1001, (docs[0][1] or "").upper().replace(" ", ",  "))]
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    nothing = stored(frame.limit(0).selectExpr("doc_id", "0L AS text_key"), "known")
    found = {(r["doc_id"], r["text_key"]): r["n_passage_words"] for r in short_passages(frame, nothing, n_words).collect()}
    keys = frame.selectExpr("doc_id", "text", "xxhash64(text) AS k").collect()
    expected = {(r["doc_id"], r["k"]): n for r, (_, n) in zip(keys, _passages([(r["doc_id"], r["text"]) for r in keys], n_words)) if n}
    assert found == expected and found
    # Rows that are known are left out, and still count as others' counterparts.
    known = stored(frame.filter("doc_id = 0").selectExpr("doc_id", "xxhash64(text) AS text_key"), "known")
    rest = {(r["doc_id"], r["text_key"]): r["n_passage_words"] for r in short_passages(frame, known, n_words).collect()}
    assert rest == {k: n for k, n in expected.items() if k[0] != 0}
    assert short_passages(frame.limit(0), nothing, n_words).collect() == []
