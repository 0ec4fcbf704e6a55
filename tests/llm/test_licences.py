import random

import numpy as np

from brute import words
from wearlog.llm.licences import TEMPLATES, build_index, scan_licences

MIT = next(t for t in TEMPLATES if t.name == "mit-text")


def _plain(text, templates=TEMPLATES):
    w, found = words(text), []
    for template in templates:
        own = template.words
        for start in range(len(w) - len(own) + 1):
            same = [w[start + i] == word for i, word in enumerate(own)]
            if sum(same) >= template.needed and all(same[i] for i in template.mandatory):
                found.append((template.name, start, round(sum(same) / len(own), 6)))
    return sorted(found, key=lambda f: (f[1], [t.name for t in templates].index(f[0])))


def _found(docs, **options):
    rows = scan_licences(docs, ["doc_id"], **options).collect()
    return {
        r["doc_id"]: (r["n_words"], [(m["name"], m["start"], round(m["cover"], 6)) for m in r["matches"]])
        for r in rows
    }


def test_equals_the_plain_version(spark, corpus, prose):
    rng = random.Random(4)
    texts = [row[1] for row in corpus]
    for i in range(200):
        parts = words(prose(rng, "en", 30))
        for template in rng.sample(TEMPLATES, 2):
            own = list(template.words)
            for _ in range(rng.randint(0, 3)):
                own[rng.randrange(len(own))] = "other"
            at = rng.randrange(len(parts))
            parts[at:at] = own[: rng.choice([len(own), len(own), len(own) - 1])]
        texts.append(" ".join(x.upper() if i % 2 else x for x in parts))
    texts.append("license " * 40 + "gnu general public license " * 3)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    found = _found(docs)
    assert found == {i: (len(words(t)), _plain(t)) for i, t in enumerate(texts)}
    names = {name for _, matches in found.values() for name, _, _ in matches}
    assert len(names) == len(TEMPLATES)


def test_mandatory_phrases_decide(spark):
    whole = list(MIT.words)
    changed, broken = list(whole), list(whole)
    changed[12] = "another"
    broken[2] = "never"
    docs = spark.createDataFrame(
        [(1, " ".join(changed)), (2, " ".join(broken))], "doc_id long, text string"
    )
    found = _found(docs)
    assert [name for name, _, _ in found[1][1]] == ["mit-text"] and found[2][1] == []


def test_rare_words_come_first(documents):
    index = build_index(documents, TEMPLATES)
    for own, anchors in zip(index.words, index.anchors):
        df = index.df[own]
        assert df[anchors].max() <= np.sort(df)[len(anchors) - 1]


def test_awkward_rows(awkward):
    rows = scan_licences(awkward, awkward.columns)
    assert rows.columns.count("n_words") == 1 and "found_n_words" in rows.columns
    assert len(rows.collect()) == awkward.count()
    assert all(r["matches"] == [] for r in rows.collect())
    assert scan_licences(awkward.limit(0), ["doc_id"]).collect() == []
    assert len(scan_licences(awkward, ["doc_id"], templates=[]).collect()) == awkward.count()
