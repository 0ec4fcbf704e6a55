"""Licence scans (operator 4): a positional rare-token index.

Templates are word sequences. Spark counts, over all documents, in how many each template word occurs;
that gives the inverse document frequency of every licence word. A file is scanned once: its places of
the rarest words of each template ("anchors") are looked up, each gives a start (place less offset), and
at these starts the postings of the template's other words are intersected by relative position.
A start counts if at least ``cover`` of the template's words stand in place and the words of every
mandatory phrase do.

As many of a template's rarest words are anchors as it may miss, plus one, so no match can avoid all.
"""

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wearlog.llm.flat import U64, Words, flat_text, word_hash
from wearlog.llm.rows import scan


@dataclass(frozen=True)
class Template:
    name: str
    label: str
    text: str
    """Words, lower case, apart by blanks; mandatory phrases in brackets."""
    cover: float = 1.0
    """Share of the words that must stand in place."""
    base: bool = False

    @property
    def words(self) -> list[str]:
        return self.text.replace("[", "").replace("]", "").split()

    @property
    def mandatory(self) -> list[int]:
        """Places of the words of mandatory phrases."""
        out, inside = [], False
        for i, word in enumerate(self.text.split()):
            inside = inside or word.startswith("[")
            if inside:
                out.append(i)
            inside = inside and not word.endswith("]")
        return out

    @property
    def needed(self) -> int:
        """Words that must stand in place."""
        return max(1, int(np.ceil(self.cover * len(self.words) - 1e-9)))


# The four phrases, and how licences are commonly named and worded.
TEMPLATES = [
    Template("gpl", "gpl", "[gnu general public license]", base=True),
    Template("apache", "apache", "[apache license]", base=True),
    Template("cc-by", "cc-by", "[cc by]", base=True),
    Template("mit", "mit", "[mit license]", base=True),
    Template("gpl-3", "gpl-3.0", "[gnu general public license version 3]"),
    Template("gpl-2", "gpl-2.0", "[gnu general public license version 2]"),
    Template("lgpl", "lgpl", "[gnu lesser general public license]"),
    Template("agpl", "agpl", "[gnu affero general public license]"),
    Template("apache-2", "apache-2.0", "[apache license version 2 0]"),
    Template("cc-by-nc", "cc-by-nc", "[cc by nc]"),
    Template("cc-by-sa", "cc-by-sa", "[cc by sa]"),
    Template("mpl", "mpl", "[mozilla public license]"),
    Template("bsd", "bsd", "[bsd license]"),
    Template(
        "mit-text",
        "mit",
        "[permission is hereby granted free of charge] to any person obtaining a copy of this software "
        "and associated documentation files the software to deal in the software [without restriction]",
        cover=0.8,
    ),
    Template(
        "bsd-text",
        "bsd",
        "[redistribution and use in source and binary forms] with or without modification are permitted "
        "provided that the [following conditions are met]",
        cover=0.8,
    ),
    Template(
        "apache-text",
        "apache",
        "licensed under the [apache license] version 2 0 the license you may not use this file except in "
        "[compliance with the license]",
        cover=0.8,
    ),
    Template(
        "gpl-text",
        "gpl",
        "this program is [free software] you can [redistribute it and or modify it] under the terms of the "
        "gnu general public license as published by the free software foundation",
        cover=0.8,
    ),
]


@dataclass
class Index:
    """Templates by word number; words sorted by hash."""

    hashes: np.ndarray
    df: np.ndarray
    """Documents that hold each word."""
    words: list[np.ndarray] = field(default_factory=list)
    anchors: list[np.ndarray] = field(default_factory=list)
    """Places within each template, rarest word first."""
    mandatory: list[np.ndarray] = field(default_factory=list)
    needed: list[int] = field(default_factory=list)


def _numbers(known: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """The number of each word, -1 for words of no template."""
    if len(known) == 0:
        return np.full(len(hashes), -1, np.int32)
    at = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
    return np.where(known[at] == hashes, at, -1).astype(np.int32)


def build_index(docs: DataFrame, templates: list[Template], text: str = "text") -> Index:
    """Counts documents per template word; one row per word and task reaches the shuffle."""
    vocabulary = sorted({word for template in templates for word in template.words})
    hashes = np.array(sorted(word_hash(word) for word in vocabulary), U64)

    def holders(part: pa.RecordBatch) -> list[pa.Array]:
        words = Words(*flat_text(part.column(part.num_columns - 1)))
        numbers = _numbers(hashes, words.hashes)
        held = np.flatnonzero(numbers >= 0)
        doc = np.searchsorted(words.first, held, "right") - 1
        pairs = np.unique(doc * len(hashes) + numbers[held])
        counts = np.bincount(pairs // max(1, len(hashes)), minlength=part.num_rows)
        lists = pa.ListArray.from_arrays(
            pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32()),
            pa.array((pairs % max(1, len(hashes))).astype(np.int32)),
        )
        return [lists]

    held = scan(docs, [], F.col(f"`{text}`"), holders, "numbers array<int>")
    counts = held.select(F.explode("numbers").alias("number")).groupBy("number").count().collect()
    df = np.zeros(len(hashes), np.int64)
    for row in counts:
        df[row["number"]] = row["count"]
    index = Index(hashes, df)
    for template in templates:
        own = _numbers(hashes, np.array([word_hash(word) for word in template.words], U64))
        # The fewer documents, the higher the inverse document frequency.
        by_rarity = np.lexsort((np.arange(len(own)), df[own]))
        index.words.append(own)
        index.anchors.append(by_rarity[: len(own) - template.needed + 1])
        index.mandatory.append(np.array(template.mandatory, np.int64))
        index.needed.append(template.needed)
    return index


def match(index: Index, words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Template, place of the first word (over all rows) and share of words in place, per match,
    ordered by place and template."""
    numbers = _numbers(index.hashes, words.hashes)
    held = np.flatnonzero(numbers >= 0)
    order = np.argsort(numbers[held], kind="stable")
    held, sorted_numbers = held[order], numbers[held][order]
    first = np.searchsorted(sorted_numbers, np.arange(len(index.hashes) + 1))
    found = []
    for t, own in enumerate(index.words):
        starts = [
            held[first[own[a]] : first[own[a] + 1]] - a for a in index.anchors[t].tolist()
        ]
        start = np.unique(np.concatenate(starts))
        start = start[start >= 0]
        doc = np.searchsorted(words.first, start, "right") - 1
        # The anchor's own row: a start before the row lies in another one.
        inside = start + len(own) <= words.first[doc + 1]
        start = start[inside]
        in_place = numbers[start[:, None] + np.arange(len(own))[None, :]] == own[None, :]
        good = in_place.sum(axis=1) >= index.needed[t]
        good &= in_place[:, index.mandatory[t]].all(axis=1)
        found.append(
            np.stack([np.full(good.sum(), t), start[good], in_place[good].sum(axis=1)], axis=1)
        )
    rows = np.concatenate(found) if found else np.zeros((0, 3), np.int64)
    rows = rows[np.lexsort((rows[:, 0], rows[:, 1]))]
    sizes = np.array([len(own) for own in index.words] or [1])
    return rows[:, 0], rows[:, 1], rows[:, 2] / sizes[rows[:, 0]]


MATCH = "struct<name:string,label:string,base:boolean,start:long,n_words:long,cover:double>"


def scan_licences(
    docs: DataFrame,
    keep: list[str],
    text: str = "text",
    templates: list[Template] = TEMPLATES,
) -> DataFrame:
    """The columns ``keep`` with ``n_words`` and ``matches`` (template, label, first word from 0, its
    number of words, share of them in place), ordered by place, of every row.

    - Words: what ``flat.Words`` says. Null and empty texts have none and match nothing.
    - Matches may overlap; all are returned. Repeated rows get the same result.
    - An empty table gives an empty table; kept columns may have any names (see ``rows.scan``).
    - Two words count as equal if their 64-bit hashes are equal.
    """
    shared = docs.sparkSession.sparkContext.broadcast(vars(build_index(docs, templates, text)))
    names = pa.array([t.name for t in templates], pa.string())
    labels = pa.array([t.label for t in templates], pa.string())
    bases = pa.array([t.base for t in templates], pa.bool_())
    sizes = pa.array([len(t.words) for t in templates], pa.int64())

    def work(part: pa.RecordBatch) -> list[pa.Array]:
        words = Words(*flat_text(part.column(part.num_columns - 1)))
        template, place, cover = match(Index(**shared.value), words)
        doc = np.searchsorted(words.first, place, "right") - 1
        at = pa.array(template)
        items = pa.StructArray.from_arrays(
            [
                names.take(at),
                labels.take(at),
                bases.take(at),
                pa.array(place - words.first[doc]),
                sizes.take(at),
                pa.array(cover),
            ],
            ["name", "label", "base", "start", "n_words", "cover"],
        )
        counts = np.bincount(doc, minlength=part.num_rows)
        lists = pa.ListArray.from_arrays(
            pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32()), items
        )
        return [pa.array(np.diff(words.first)), lists]

    fields = f"n_words long; matches array<{MATCH}>"
    return scan(docs, keep, F.col(f"`{text}`"), work, fields, prefix="found_")
