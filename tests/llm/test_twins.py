"""Plain versions of what SQL cannot express: language mixtures and toxicity scores, on given documents."""

import math
import re
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest

from wearlog.llm.flat import flat_text
from wearlog.llm.language import (
    gram_buckets,
    identify_languages,
    learn_languages,
    unit_likelihoods,
)
from wearlog.llm.queries import remainder
from wearlog.llm.rows import read
from wearlog.llm.toxicity import LOOK_ALIKE, learn_toxicity, score_toxicity

SF = "/root/testdata/sf0.01"


def _mixture(units, penalty=1.0):
    """The best of all sets of languages by penalised likelihood: its shares of the units, each by plain
    expectation-maximisation."""
    n, languages = units.shape
    best = (-math.inf, None)
    for size in range(1, languages + 1):
        for chosen in combinations(range(languages), size):
            shares = {k: 1 / size for k in chosen}
            for _ in range(60 if size > 1 else 0):
                total = dict.fromkeys(chosen, 0.0)
                for unit in units:
                    top = max(unit[k] for k in chosen)
                    joint = {k: shares[k] * math.exp(unit[k] - top) for k in chosen}
                    whole = sum(joint.values())
                    for k in chosen:
                        total[k] += joint[k] / whole
                shares = {k: total[k] / n for k in chosen}
            fit = 0.0
            for unit in units:
                top = max(unit[k] for k in chosen)
                fit += top + math.log(max(1e-300, sum(shares[k] * math.exp(unit[k] - top) for k in chosen)))
            fit -= (size - 1) * penalty * 0.5 * math.log(max(n, 2))
            if fit > best[0] + 1e-9:
                best = (fit, shares)
    return best[1]


def test_mixtures_equal_the_best_of_all_sets(spark):
    docs = read(spark, "/root/testdata/sf0.001", "documents")
    texts = {r["doc_id"]: r["text"] for r in docs.collect() if r["text"] and len(r["text"]) < 3000}
    ids = sorted(texts)[:90]
    # Halves of two documents each: mixtures of two languages, mostly.
    mixed = {1000 + i: f"{texts[a][:700]} {texts[b][:700]}" for i, (a, b) in enumerate(zip(ids[:30], ids[7:37]))}
    plain = {i: texts[i] for i in ids} | mixed
    model = learn_languages(docs)
    frame = spark.createDataFrame(list(plain.items()), "doc_id long, text string")
    rows = {r["doc_id"]: r for r in identify_languages(frame, model, ["doc_id"]).collect()}
    same_sets = 0
    for i, text in plain.items():
        units, sizes, _ = unit_likelihoods(model, *gram_buckets(*flat_text(pa.array([text.lower()]))))
        if not len(units):
            continue
        shares = _mixture(units)
        # Shares of units to shares of grams, as reported.
        grams = np.zeros(len(model.languages))
        for unit, size in zip(units, sizes):
            top = unit.max()
            joint = np.array([shares.get(k, 0) * math.exp(unit[k] - top) for k in range(len(unit))])
            grams += size * joint / joint.sum()
        grams /= grams.sum()
        best = model.languages[int(grams.argmax())]
        found = {s["lang"]: s["share"] for s in rows[i]["shares"]}
        # Growing the set one by one may stop at another set; then the leading language still agrees.
        if grams.max() > 0.55:
            assert rows[i]["lang_pred"] == best
        if set(found) == {model.languages[k] for k in shares}:
            same_sets += 1
            for k in shares:
                assert found[model.languages[k]] == pytest.approx(grams[k], abs=0.03)
    assert same_sets >= 0.9 * len(plain)


def _folded(text):
    """The words of a text without signs, letters folded one by one."""
    out = []
    for char in text or "":
        low = char.lower()
        low = LOOK_ALIKE.get(low, low)
        out.append(("i" if low == "l" else low) if len(low) == 1 and low.isalpha() else " ")
    return "".join(out).split()


def _score(model, text):
    words = _folded(text)
    shielded = set()
    for size in (1, 2):
        for i in range(len(words) - size + 1):
            if f" {' '.join(words[i : i + size])} " in set(model.exceptions):
                shielded.update(range(i, i + size))
    hits, total = 0, 0.0
    for i, word in enumerate(words):
        terms = [t for t in model.weights if t == f" {word} " or (t[-1] != " " and f" {word}".startswith(t))]
        if terms and i not in shielded:
            hits += 1
            total += model.weights[max(terms, key=len)]
    power = model.slope * math.log1p(100 * total / (len(words) + 10)) + model.offset
    return hits, len(words), 1 / (1 + math.exp(-min(50, max(-50, power))))


def test_toxicity_scores_equal_a_naive_matcher(spark):
    docs = read(spark, SF, "documents")
    model = learn_toxicity(docs, read(spark, SF, "labels").filter(remainder(5) != 0))
    assert model.weights
    # An exception of each length, should none have been learned: a term's word, and a pair that occurs.
    term = max(model.weights, key=model.weights.get).strip()
    pairs = [
        (w[i], w[i + 1]) for r in docs.limit(400).collect()
        for w in [_folded(r["text"])] for i in range(len(w) - 1) if w[i].startswith(term)
    ]
    model.exceptions = [*model.exceptions, *(f" {' '.join(pair)} " for pair in pairs[:3])]
    rows = {r["doc_id"]: r for r in score_toxicity(docs, model, ["doc_id"]).collect()}
    # Signs have several readings; texts with any are judged by the other tests.
    plain = [r for r in docs.select("doc_id", "text").collect() if not re.search(r"[0-9@$!|]", r["text"] or "")]
    assert len(plain) > 500
    with_hits = 0
    for r in plain:
        hits, n_words, score = _score(model, r["text"])
        got = rows[r["doc_id"]]
        assert (len(got["hits"]), got["n_words"]) == (hits, n_words), r["doc_id"]
        assert got["score"] == pytest.approx(score)
        with_hits += hits > 0
    assert with_hits >= 20
