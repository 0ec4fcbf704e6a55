"""Toxicity (operator 3): a weighted lexicon matched by Aho-Corasick on folded text.

Folding maps each code point to one code point: lower case, look-alike letters of other scripts and
full-width, mathematical and circled forms to plain letters (NFKC), digits and signs that stand for letters
(where a letter of the same word stands on either side) to these letters, ``l`` to ``i`` (both are written
as 1), everything else to a blank. Runs of blanks become one. Offsets in the original text are kept.

Signs behind a word's last letter may be letters or not: learning takes ``!`` and ``|`` there as blanks and
digits, ``$`` and ``@`` as letters; scoring also reads such words with all of them as blanks and as letters.

Learning uses a bounded sample of the labelled rows (``most_rows``, a documented limit):
1. words and word beginnings in toxic rows are counted, then the same terms in clean rows;
2. terms that speak for toxic rows by a clear margin make up the lexicon, weighted by their log odds; a
   term is left out if a shorter beginning says as much;
3. words and neighbouring word pairs around hits that speak for clean rows become exceptions;
4. a logistic curve is fitted to the weight per word.

Scoring: one automaton finds terms and exceptions in a single pass; a hit within an exception does not
count; of several terms at one word the longest counts. The sum of weights is divided by the number of
words (plus a constant) and mapped to 0..1.
"""

import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wearlog.llm.flat import column_of, flat_text, slices
from wearlog.llm.rows import scan
from wearlog.session import stored

# Letters of other scripts that look like Latin ones, and what signs stand for.
LOOK_ALIKE = {
    "а": "a", "в": "b", "с": "c", "ԁ": "d", "е": "e", "һ": "h", "і": "i", "ј": "j", "к": "k",
    "м": "m", "н": "h", "о": "o", "р": "p", "ԛ": "q", "ѕ": "s", "т": "t", "у": "y", "ѵ": "v",
    "ԝ": "w", "х": "x", "α": "a", "ε": "e", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p",
    "τ": "t", "υ": "u", "χ": "x", "ı": "i", "ɡ": "g", "ո": "n", "օ": "o", "ս": "u",
}
STANDS_FOR = {
    "0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "@": "a", "$": "s",
    "!": "i", "|": "i",
}

#: Signs that are mostly punctuation behind a word.
PUNCTUATION = "!|"

BLANK, SIGN, SOFT = 32, 0x80000000, 0x40000000
#: Stands for words that a reading leaves out; no term holds it.
LEFT_OUT = 10
MIN_STEM, MAX_STEM = 4, 10
#: How signs behind a word's last letter are read: all but punctuation as letters, none, all.
PLAIN, BARE, FULL = range(3)


def _fold_point(point: int) -> int:
    """The folded letter of a code point, a blank, or a sign with its letter."""
    char = chr(point)
    if 0xD800 <= point < 0xE000:
        return BLANK
    # Other forms of one letter, or of a sign where they are full-width or beyond the first 65536.
    other = unicodedata.normalize("NFKC", char)
    if len(other) == 1 and (other.isalpha() or (point >= 0xFF01 and other in STANDS_FOR)):
        char = other
    if char in STANDS_FOR:
        return SIGN | (SOFT if char in PUNCTUATION else 0) | ord(STANDS_FOR[char])
    low = char.lower()
    low = LOOK_ALIKE.get(low, low)
    if len(low) == 1 and low.isalpha():
        return ord("i") if low == "l" else ord(low)
    return BLANK


_table: list[np.ndarray] = []


@dataclass
class Spread:
    """All rows, each followed by a blank and the whole preceded by one."""

    points: np.ndarray
    """Folded code points, of which signs are not yet read."""
    origin: np.ndarray
    """The original code point (counted over all rows) of each."""
    first: np.ndarray
    """Where the rows begin."""
    signs: np.ndarray
    opens: np.ndarray
    """Places of signs, and of the blanks before their words."""
    letters: tuple[np.ndarray, np.ndarray, np.ndarray]
    """By reading, which signs are letters."""


def spread_out(text: np.ndarray, at: np.ndarray) -> Spread:
    if not _table:
        _table.append(np.array([_fold_point(point) for point in range(1 << 16)], np.uint32))
    points = np.frombuffer(text.tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
    opens = np.concatenate([[0], np.cumsum((text & 0xC0) != 0x80)])[at]
    folded = np.full(len(points), BLANK, np.uint32)
    low = points < (1 << 16)
    folded[low] = _table[0][points[low]]
    if not low.all():
        # Few of the million others occur in a text.
        kinds, which = np.unique(points[~low], return_inverse=True)
        folded[~low] = np.array([_fold_point(point) for point in kinds.tolist()], np.uint32)[which]
    # One blank before all rows and one after each.
    place = np.repeat(np.arange(len(at) - 1), np.diff(opens)) + np.arange(len(points)) + 1
    spread = np.full(len(points) + len(at), BLANK, np.uint32)
    spread[place] = folded
    origin = np.zeros(len(spread), np.int64)
    origin[place] = np.arange(len(points))
    return Spread(spread, origin, np.arange(len(at)) + opens, *_sign_readings(spread))


def _sign_readings(points: np.ndarray) -> tuple[np.ndarray, np.ndarray, tuple]:
    """Signs count as letters in words that hold a letter; behind the last one, as each reading has it."""
    is_sign, blank = points >= SIGN, points == BLANK
    signs, blanks = np.flatnonzero(is_sign), np.flatnonzero(blank)
    # The first and the last place are blanks.
    after = np.searchsorted(blanks, signs)
    opens, closes = blanks[after - 1], blanks[np.minimum(after, len(blanks) - 1)]

    def around(wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The last of the wanted places before each sign, the first from it on."""
        places = np.concatenate([[-1], np.flatnonzero(wanted), [len(points)]])
        at = np.searchsorted(places, signs)
        return places[at - 1], places[at]

    before, behind = around(~blank & ~is_sign)
    inside = behind < closes
    last = ~inside & (before > opens)
    # A run of punctuation at the very end.
    soft = last & (around(is_sign & ((points & SOFT) == 0))[1] > closes)
    return signs, opens, (inside | (last & ~soft), inside, inside | last)


def read_signs(spread: Spread, reading: int = PLAIN) -> tuple[str, np.ndarray, np.ndarray, np.ndarray]:
    """The folded string; the place in ``spread`` of each of its code points; where the rows begin; and where
    words begin that differ from the reading ``PLAIN``. Other readings hold nothing but these words with a
    neighbour on each side.
    """
    points, letters = spread.points.copy(), spread.letters[reading]
    signed = points[spread.signs] & ~np.uint32(SIGN | SOFT)
    points[spread.signs] = np.where(letters, signed, np.uint32(BLANK))
    changed = np.zeros(len(points), bool)
    changed[spread.opens[letters != spread.letters[PLAIN]] + 1] = True
    blank = points == BLANK
    chosen = np.arange(len(points))
    if reading != PLAIN:
        begins = ~blank
        begins[1:] &= blank[:-1]
        word = np.cumsum(begins)
        near = np.zeros(word[-1] + 3, bool)
        own = word[changed]
        near[own] = near[own - 1] = near[own + 1] = True
        far = ~blank & ~near[word]
        points[far] = LEFT_OUT
        # Of each run of words left out one code point and its blank stay.
        chosen = np.flatnonzero(~far | (begins & near[word - 1]))
        blank = blank[chosen]
    keep = np.ones(len(chosen), bool)
    keep[1:] = ~(blank[1:] & blank[:-1])
    chosen = chosen[keep]
    first = np.searchsorted(chosen, spread.first)
    return points[chosen].tobytes().decode("utf-32-le"), chosen, first, changed[chosen]


def fold(text: np.ndarray, at: np.ndarray) -> tuple[str, np.ndarray, np.ndarray]:
    """All rows as one folded string, each row followed by a blank and the whole preceded by one;
    the original code point (counted over all rows) of each place; where the rows begin."""
    spread = spread_out(text, at)
    folded, places, first, _ = read_signs(spread)
    return folded, spread.origin[places], first


@dataclass
class ToxicityModel:
    weights: dict[str, float] = field(default_factory=dict)
    """By folded term: ``" stem"`` matches words that begin so, ``" word "`` whole words."""
    exceptions: list[str] = field(default_factory=list)
    """Folded words or word pairs with a blank at both ends, in which hits do not count."""
    slope: float = 1.0
    offset: float = 0.0
    """Score = 1 / (1 + exp(-(slope * evidence + offset)))."""

    def automaton(self) -> "ahocorasick.Automaton":
        machine = ahocorasick.Automaton()
        for term, weight in self.weights.items():
            machine.add_word(term, (len(term), weight))
        for phrase in self.exceptions:
            machine.add_word(phrase, (len(phrase), None))
        machine.make_automaton()
        return machine


#: Added to the number of words, so that one hit in a short text is not everything.
PRIOR_WORDS = 10.0


@dataclass
class Hits:
    """Of each hit: where its word begins (the blank before it), its row and its weight."""

    starts: np.ndarray
    ends: np.ndarray
    rows: np.ndarray
    weights: np.ndarray
    n_words: np.ndarray


def find_hits(machine, folded: str, first: np.ndarray) -> Hits:
    """``first``: n + 1 places where rows begin."""
    points = np.frombuffer(folded.encode("utf-32-le"), np.uint32)
    # Words of a row: blanks in front of letters, its own end blank excepted.
    ahead = np.zeros(len(points) + 1, bool)
    ahead[1 : len(points)] = (points[:-1] == BLANK) & (points[1:] != BLANK)
    words = np.concatenate([[0], np.cumsum(ahead[: len(points)])])
    n_words = words[first[1:]] - words[first[:-1]]
    best: dict[int, tuple[int, float]] = {}
    shields: list[tuple[int, int]] = []
    if len(machine):
        for end, (size, weight) in machine.iter(folded):
            start = end - size + 1
            if weight is None:
                shields.append((start, end))
            elif start not in best or best[start][0] < size:
                best[start] = (size, weight)
    starts = np.array(sorted(best), np.int64)
    weights = np.array([best[s][1] for s in starts.tolist()], np.float64)
    ends = np.array([s + best[s][0] - 1 for s in starts.tolist()], np.int64)
    if shields and len(starts):
        cover = np.zeros(len(points) + 1, np.int64)
        np.add.at(cover, [s for s, _ in shields], 1)
        np.add.at(cover, [e for _, e in shields], -1)
        free = np.cumsum(cover)[starts] == 0
        starts, ends, weights = starts[free], ends[free], weights[free]
    rows = np.searchsorted(first, starts + 1, "right") - 1
    return Hits(starts, ends, rows, weights, n_words)


def read_hits(machine, text: np.ndarray, at: np.ndarray) -> Hits:
    """Hits in any reading of the signs, the longest of each word; ``starts`` and ``ends`` are the original
    code points (counted over all rows) of the first and the last letter."""
    spread = spread_out(text, at)
    parts = []
    for reading in (PLAIN, BARE, FULL):
        if reading != PLAIN and (spread.letters[reading] == spread.letters[PLAIN]).all():
            continue
        folded, places, first, changed = read_signs(spread, reading)
        found = find_hits(machine, folded, first)
        if reading == PLAIN:
            n_words = found.n_words
        own = np.ones(len(found.starts), bool) if reading == PLAIN else changed[found.starts + 1]
        starts, ends = found.starts[own], found.ends[own]
        points = np.frombuffer(folded.encode("utf-32-le"), np.uint32)
        last = np.where(points[ends] == BLANK, ends - 1, ends)
        parts.append((places[starts + 1], places[last], ends - starts, found.rows[own], found.weights[own]))
    begins, lasts, sizes, rows, weights = (np.concatenate(column) for column in zip(*parts))
    order = np.lexsort((-sizes, begins))
    order = order[np.diff(begins[order], prepend=-1) > 0]
    return Hits(spread.origin[begins[order]], spread.origin[lasts[order]], rows[order], weights[order], n_words)


def evidence(hits: Hits) -> np.ndarray:
    """Weight per word of each row."""
    sums = np.bincount(hits.rows, hits.weights, minlength=len(hits.n_words))
    return np.log1p(100 * sums / (hits.n_words + PRIOR_WORDS))


def _terms(words: list[str]) -> Counter:
    """How often each term of a row stands in it."""
    found: Counter = Counter()
    for word, n in Counter(words).items():
        found[f" {word} "] += n
        for size in range(MIN_STEM, min(MAX_STEM, len(word)) + 1):
            found[f" {word[:size]}"] += n
    return found


def _folded_rows(part: pa.RecordBatch) -> list[str]:
    folded, _, first = fold(*flat_text(column_of(part, "body")))
    return [folded[a:b] for a, b in zip(first[:-1], first[1:])]


def _copy_key(part: pa.RecordBatch) -> list[pa.Array]:
    """128 bits of all folded words of each row in order, which only copies share."""
    rows = (xxhash.xxh3_128_hexdigest(" ".join(row.split()).encode()) for row in _folded_rows(part))
    return [pa.array(rows, pa.string())]


def _count_terms(wanted):
    """``wanted``: a broadcast set of terms, or None for all terms. The term ``""`` counts words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: Counter = Counter()
        places: Counter = Counter()
        for batch in batches:
            for part in slices(batch, "body"):
                for row in _folded_rows(part):
                    words = row.split()
                    own = _terms(words)
                    if wanted is not None:
                        own = {term: own[term] for term in own.keys() & wanted.value}
                    rows.update(own.keys())
                    places.update(own)
                    rows[""] += 1
                    places[""] += len(words)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(rows.keys(), pa.string()),
                pa.array(rows.values(), pa.int64()),
                pa.array([places[term] for term in rows], pa.int64()),
            ],
            names=["term", "rows", "places"],
        )

    return run


def _count_contexts(model):
    """Words that hold a hit, alone and with each neighbour, once per row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = ToxicityModel(**model.value).automaton()
        counts: Counter = Counter()
        for batch in batches:
            for part in slices(batch, "body"):
                labels = column_of(part, "toxic").to_pylist()
                folded, _, first = fold(*flat_text(column_of(part, "body")))
                found = find_hits(machine, folded, first)
                seen = set()
                for start, row in zip(found.starts.tolist(), found.rows.tolist()):
                    low, high = first[row], first[row + 1]
                    end = folded.find(" ", start + 1)
                    seen.add((row, folded[start : end + 1]))
                    before = folded.rfind(" ", low, start)
                    if before >= 0:
                        seen.add((row, folded[before : end + 1]))
                    after = folded.find(" ", end + 1, high)
                    if after >= 0:
                        seen.add((row, folded[start : after + 1]))
                counts.update((phrase, labels[row]) for row, phrase in seen)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([p for p, _ in counts], pa.string()),
                pa.array([t for _, t in counts], pa.int64()),
                pa.array(counts.values(), pa.int64()),
            ],
            names=["phrase", "toxic", "n"],
        )

    return run


@dataclass
class Count:
    """Rows that hold a term, and its places."""

    rows: int = 0
    places: int = 0


def _odds(bad: Count, good: Count, all_bad: Count, all_good: Count) -> tuple[float, float]:
    """Log ratio of a term's places per word in toxic and in clean rows, and its standard error, for
    which a row counts once however often it repeats the term."""
    odds = np.log((bad.places + 0.5) / (all_bad.places + 1))
    odds -= np.log((good.places + 0.5) / (all_good.places + 1))
    return float(odds), float(np.sqrt(1 / (bad.rows + 0.5) + 1 / (good.rows + 0.5)))


def _lexicon(bad: dict[str, Count], good: dict[str, Count], margin: float) -> dict[str, float]:
    """Terms whose log odds exceed 1 by ``margin`` standard errors.

    From the shortest on; a longer term joins only if it says clearly more than its beginnings. A
    chosen beginning that stands almost only in one longer term is replaced by that.
    """
    none = Count()
    chosen: dict[str, float] = {}
    for term in sorted(bad, key=lambda t: (len(t.strip()), t.endswith(" "), t)):
        if not term:
            continue
        odds, error = _odds(bad[term], good.get(term, none), bad[""], good[""])
        if odds - margin * error < 1:
            continue
        bare = term.rstrip()
        parents = [chosen[bare[:i]] for i in range(MIN_STEM + 1, len(bare) + 1) if bare[:i] in chosen]
        if all(odds > parent + 0.7 for parent in parents):
            chosen[term] = odds
    longest: dict[str, str] = {}
    for term in sorted(bad, key=lambda t: (len(t), t)):
        for size in range(MIN_STEM + 1, len(term)):
            start = term[:size]
            if start in chosen and bad[term].places >= 0.95 * bad[start].places:
                longest[start] = term
    return {longest.get(term, term): odds for term, odds in chosen.items()}


def _logistic(x: np.ndarray, y: np.ndarray, rounds: int = 50) -> tuple[float, float]:
    """Slope and offset by Newton's method, with a weak pull to 0 against separable data."""
    design = np.stack([x, np.ones_like(x)], axis=1)
    beta = np.zeros(2)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        gradient = design.T @ (y - p) - 0.01 * beta
        hessian = (design * (p * (1 - p))[:, None]).T @ design + 0.01 * np.eye(2)
        step = np.linalg.solve(hessian, gradient)
        beta += np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return float(beta[0]), float(beta[1])


def learn_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    toxic: str = "toxic",
    most_rows: int = 20_000,
    min_rows: int = 4,
    margin: float = 2.0,
) -> ToxicityModel:
    """Learn from about ``most_rows`` labelled rows at most, chosen by a hash of their id.

    Terms must stand in ``min_rows`` toxic rows. Rows without label or id are left out; an id with
    several labels takes the highest. Copies, rows whose folded words are the same in the same order, count
    once for each label; of them the row with the smallest id stays, so the same tables give the same model.
    Without toxic or without clean rows nothing is learned, and every text scores 0.
    """
    spark = docs.sparkSession
    known = (
        labels.select(F.col(id).alias("label_id"), F.col(toxic).cast("int").alias("toxic"))
        .filter(F.col("label_id").isNotNull() & F.col("toxic").isin(0, 1))
        .groupBy("label_id")
        .agg(F.max("toxic").alias("toxic"))
    )
    share = min(1.0, most_rows / max(1, known.count()))
    spread = F.pmod(F.xxhash64("label_id"), F.lit(1 << 20))
    chosen = known.filter(spread < F.lit(int(share * (1 << 20))))
    # At most about most_rows rows of 12 bytes.
    rows = (
        docs.select(F.col(id).alias("id"), F.col(text).alias("body"))
        .join(F.broadcast(chosen), F.col("id") == F.col("label_id"))
        .select("id", "body", "toxic")
    )
    # Copies are no evidence of their own.
    marked = scan(rows, ["id", "body", "toxic"], F.col("body"), _copy_key, "copy string")
    one = marked.groupBy("copy", "toxic").agg(F.min(F.struct("id", "body")).alias("row"))
    sample = stored(one.select("row.body", "toxic"), "labelled")
    sizes = {r["toxic"]: r["n"] for r in sample.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    n_toxic, n_clean = sizes.get(1, 0), sizes.get(0, 0)
    if not n_toxic or not n_clean:
        return ToxicityModel(slope=0.0, offset=-50.0)

    def counted(label: int, wanted, least: int) -> dict[str, Count]:
        """Terms of enough rows; at most those of the sample."""
        counts = (
            sample.filter(F.col("toxic") == label)
            .select("body")
            .mapInArrow(_count_terms(wanted), "term string, rows long, places long")
            .groupBy("term")
            .agg(F.sum("rows").alias("rows"), F.sum("places").alias("places"))
            .filter((F.col("rows") >= least) | (F.col("term") == ""))
        )
        return {r["term"]: Count(r["rows"], r["places"]) for r in counts.collect()}

    bad = counted(1, None, min_rows)
    good = counted(0, spark.sparkContext.broadcast(set(bad)), 1)
    model = ToxicityModel(_lexicon(bad, good, margin))
    # Exceptions: what holds hits and speaks for clean rows.
    around = sample.mapInArrow(
        _count_contexts(spark.sparkContext.broadcast(vars(model))), "phrase string, toxic long, n long"
    )
    phrases: dict[str, list[int]] = {}
    for r in (
        around.groupBy("phrase")
        .agg(
            F.sum(F.when(F.col("toxic") == 1, F.col("n")).otherwise(0)).alias("bad"),
            F.sum(F.when(F.col("toxic") == 0, F.col("n")).otherwise(0)).alias("good"),
        )
        .filter(F.col("good") >= min_rows)
        .collect()
    ):
        phrases[r["phrase"]] = [r["bad"], r["good"]]
    model.exceptions = sorted(
        phrase
        for phrase, (n_bad, n_good) in phrases.items()
        if sum(_odds(Count(n_bad, n_bad), Count(n_good, n_good), bad[""], good[""])) < 0
    )
    shared = spark.sparkContext.broadcast(vars(model))
    fitted = scan(sample, ["toxic"], F.col("body"), _evidence_of(shared), "evidence double").toArrow()
    # Rows arrive in any order, and sums of fractions depend on it.
    fitted = fitted.sort_by([("evidence", "ascending"), ("toxic", "ascending")])
    model.slope, model.offset = _logistic(
        fitted["evidence"].to_numpy(), fitted["toxic"].to_numpy().astype(np.float64)
    )
    return model


def _evidence_of(shared):
    machines: list = []

    def work(part: pa.RecordBatch) -> list[pa.Array]:
        if not machines:
            machines.append(ToxicityModel(**shared.value).automaton())
        text, at = flat_text(part.column(part.num_columns - 1))
        return [pa.array(evidence(read_hits(machines[0], text, at)))]

    return work


def score_toxicity(
    docs: DataFrame, model: ToxicityModel, keep: list[str], text: str = "text"
) -> DataFrame:
    """The columns ``keep`` with ``score`` (0 to 1), ``n_words`` and ``hits`` (start, end, weight; code
    points of the original text, end exclusive) of every row.

    - Null and empty texts, and texts without a hit, score what no hit means to the fitted curve.
    - Repeated rows get the same result. Texts of any length are used as a whole.
    - An empty table gives an empty table; kept columns may have any names (see ``rows.scan``).
    """
    shared = docs.sparkSession.sparkContext.broadcast(vars(model))
    machines: list = []

    def work(part: pa.RecordBatch) -> list[pa.Array]:
        known = ToxicityModel(**shared.value)
        if not machines:
            machines.append(known.automaton())
        text, at = flat_text(part.column(part.num_columns - 1))
        found = read_hits(machines[0], text, at)
        power = np.clip(known.slope * evidence(found) + known.offset, -50, 50)
        opens = np.concatenate([[0], np.cumsum((text & 0xC0) != 0x80)])[at]
        begin = found.starts - opens[found.rows]
        end = found.ends - opens[found.rows] + 1
        counts = np.bincount(found.rows, minlength=part.num_rows)
        spans = pa.StructArray.from_arrays(
            [pa.array(begin), pa.array(end), pa.array(found.weights)], ["start", "end", "weight"]
        )
        lists = pa.ListArray.from_arrays(
            pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32()), spans
        )
        return [pa.array(1 / (1 + np.exp(-power))), pa.array(found.n_words), lists]

    fields = "score double; n_words long; hits array<struct<start:long,end:long,weight:double>>"
    return scan(docs, keep, F.col(f"`{text}`"), work, fields, prefix="found_")
