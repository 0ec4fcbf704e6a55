import random

import pytest

from wearlog.llm.flat import flat_text
from wearlog.llm.toxicity import ToxicityModel, fold, learn_toxicity, score_toxicity
import pyarrow as pa


def _folded(*texts):
    folded, origin, first = fold(*flat_text(pa.array(texts, pa.string())))
    rows = [folded[a:b] for a, b in zip(first[:-1], first[1:])]
    return rows, origin


def test_folding():
    rows, _ = _folded("1D10T!!", "ｍоrоn, ЅCUM", None, "", "5% of $cum 2.0 l0ser", "Straße É")
    assert rows[0].strip() == "idiot" and rows[1].strip() == "moron scum"
    assert rows[2].strip() == rows[3].strip() == ""
    assert rows[4].strip() == "of scum ioser" and rows[5].strip() == "straße é"


def test_signs_count_where_a_letter_stands_on_either_side():
    rows, _ = _folded("V1LES7 grubb7! a$$", "2.0 $100 5% 7 !", "no! (5x) 4.", "𝑣𝒊𝖑𝓮𝟻𝕥 ℬⓐd 𝟹", "wow!1", "😀x")
    assert [row.strip() for row in rows] == ["viiest grubbt ass", "", "no sx", "viiest bad", "wowii", "x"]


def test_signs_at_the_end_of_a_word_are_read_in_each_way(spark):
    model = ToxicityModel({" viiest ": 4.0, " grubby ": 3.0, " nazi ": 3.0}, [" not grubby "], 2.0, -3.0)
    texts = ["É: V1LES7!", "grubby7, 𝐕𝟏𝐥𝐞𝐬𝐭", "naz!", "not grubby7", "is not; grubby5 or a b c nazi! vile57", "viles7ly"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = {r["doc_id"]: r for r in score_toxicity(docs, model, ["doc_id"]).collect()}
    spans = [[texts[i][h["start"] : h["end"]] for h in rows[i]["hits"]] for i in range(6)]
    assert spans == [["V1LES7"], ["grubby", "𝐕𝟏𝐥𝐞𝐬𝐭"], ["naz!"], [], ["nazi", "vile57"], []]
    assert [rows[i]["n_words"] for i in range(6)] == [2, 2, 1, 2, 9, 1]


def test_offsets_point_into_the_text(spark):
    model = ToxicityModel({" idiot ": 4.0, " moro": 3.0}, [" no idiot "], 2.0, -3.0)
    texts = ["É,  1d10t and MОRОNS", "no  idiot", "an idiot, no idiot", "idiotic", ""]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    rows = {r["doc_id"]: r for r in score_toxicity(docs, model, ["doc_id"]).collect()}
    spans = lambda i: [texts[i][h["start"] : h["end"]] for h in rows[i]["hits"]]
    assert spans(0) == ["1d10t", "MОRО"] and spans(2) == ["idiot"]
    assert spans(1) == spans(3) == spans(4) == []
    assert rows[0]["score"] > rows[2]["score"] > 0.5 > rows[1]["score"] == rows[3]["score"]
    assert [rows[i]["n_words"] for i in range(5)] == [4, 2, 4, 1, 0]


@pytest.fixture(scope="module")
def labelled(prose):
    rng = random.Random(8)
    rows = []
    for i in range(400):
        lang, toxic = ("en", "de")[i % 2], i % 4 < 2
        parts = prose(rng, lang, 60).split(" ")
        for _ in range(4 if toxic else 0):
            bad = rng.choice(["vilest", "grubby"]) if lang == "en" else "schuft" + rng.choice(["", "en", "ig"])
            parts.insert(rng.randrange(len(parts)), bad)
        if not toxic and i % 10 == 2:
            parts += ["not", "grubby", "at", "all"]
        rows.append((i, " ".join(parts), int(toxic)))
    return rows


def test_learned_lexicon_on_held_out_rows(spark, labelled):
    docs = spark.createDataFrame([row[:2] for row in labelled], "doc_id long, text string")
    labels = spark.createDataFrame(
        [(i, toxic) for i, _, toxic in labelled if i % 5], "doc_id long, toxic int"
    )
    model = learn_toxicity(docs, labels)
    assert {" viiest ", " grubby "} <= set(model.weights)
    assert any(term.startswith(" schuft") for term in model.weights)
    assert all(weight > 1 for weight in model.weights.values())
    assert any("grubby" in phrase for phrase in model.exceptions)
    scores = {r["doc_id"]: r["score"] for r in score_toxicity(docs, model, ["doc_id"]).collect()}
    held = [(scores[i] >= 0.5) == bool(toxic) for i, _, toxic in labelled if i % 5 == 0]
    assert sum(held) >= 0.97 * len(held)
    disguised = spark.createDataFrame([(1, "the V1LE5T and grübby gru8by thing"), (2, "the thing")], "doc_id long, text string")
    found = {r["doc_id"]: r for r in score_toxicity(disguised, model, ["doc_id"]).collect()}
    assert len(found[1]["hits"]) == 2 and found[1]["score"] > 0.5 > found[2]["score"]


def test_the_sample_is_bounded(spark, labelled):
    docs = spark.createDataFrame([row[:2] for row in labelled], "doc_id long, text string")
    labels = spark.createDataFrame([(i, t) for i, _, t in labelled], "doc_id long, toxic int")
    small = learn_toxicity(docs, labels, most_rows=200, min_rows=2, margin=1.0)
    assert " grubby " in small.weights


def test_rows_with_a_common_footer_are_no_copies(spark, labelled):
    footer = "\nunsubscribe at https://extraordinarily-longwinded-newsletters.example/administration"
    docs = spark.createDataFrame([(i, text + footer) for i, text, _ in labelled], "doc_id long, text string")
    labels = spark.createDataFrame([(i, t) for i, _, t in labelled], "doc_id long, toxic int")
    model = learn_toxicity(docs, labels)
    assert {" viiest ", " grubby "} <= set(model.weights)
    # Copies with other spacing change nothing, nor does the order of the rows.
    more = docs.filter("doc_id % 3 = 0").selectExpr("doc_id + 1000 as doc_id", "replace(text, ' ', '  ') as text")
    again = labels.selectExpr("doc_id + 1000 as doc_id", "toxic").union(labels)
    assert learn_toxicity(docs.union(more).repartition(7), again) == model


def test_awkward_rows(spark, awkward):
    labels = spark.createDataFrame(
        [(1, 1), (2, 0), (None, 1), (6, None), (2, 0), (3, 1)], "doc_id long, toxic int"
    )
    model = learn_toxicity(awkward, labels, min_rows=1)
    rows = score_toxicity(awkward, model, awkward.columns)
    assert rows.columns.count("score") == 1 and {"found_score", "found_n_words"} <= set(rows.columns)
    found = rows.collect()
    assert len(found) == awkward.count() and all(0 <= r["found_score"] <= 1 for r in found)
    assert score_toxicity(awkward.limit(0), model, ["doc_id"]).collect() == []
    for part in (labels.limit(0), labels.filter("toxic = 0")):
        nothing = learn_toxicity(awkward, part)
        scores = {r["score"] for r in score_toxicity(awkward, nothing, ["doc_id"]).collect()}
        assert nothing.weights == {} and max(scores) < 1e-9
