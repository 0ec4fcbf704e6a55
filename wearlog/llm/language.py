"""Language ID (operator 1): multilingual mixture inference by expectation-maximisation.

Learning: every letter byte, with its neighbours, is a 3-gram; grams are counted per language over all
labelled rows, hashed into ``2**GRAM_BITS`` buckets. Only these counts (at most one row per language
and bucket) reach the driver.

Inference, for many documents at once: a document is a sequence of units of ``UNIT`` grams. Its
likelihood is a mixture over languages, ``sum over units of log(sum of share[l] * p(unit | l))``.
The set of languages grows from the best single one: the language along which the likelihood rises
fastest joins, expectation-maximisation estimates the shares, and the larger set is kept if the gain in
likelihood exceeds the penalty of one more share (half the logarithm of the number of units, times
``penalty``).
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wearlog.llm.flat import column_of, flat_text, slices
from wearlog.llm.rows import in_batches, scan

GRAM_BITS, UNIT = 14, 24
GRAM = 3
UNKNOWN = "und"

SPACE = np.uint8(32)
LETTER = np.full(256, SPACE, np.uint8)
for _range in (range(97, 123), range(128, 256)):
    LETTER[list(_range)] = list(_range)


def gram_buckets(text: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The bucket of each letter byte's gram and the n + 1 places where the rows' grams begin.

    ``text`` is lower-cased; anything but letters is a blank, as are the ends of a row.
    """
    middle = LETTER[text]
    before, after = np.full_like(middle, SPACE), np.full_like(middle, SPACE)
    before[1:] = middle[:-1]
    after[:-1] = middle[1:]
    edges = at[1:-1]
    edges = edges[(edges > 0) & (edges < len(text))]
    before[edges] = SPACE
    after[edges - 1] = SPACE
    place = np.flatnonzero(middle != SPACE)
    code = before[place].astype(np.uint32) << np.uint32(16)
    code |= middle[place].astype(np.uint32) << np.uint32(8)
    code |= after[place]
    with np.errstate(over="ignore"):
        bucket = (code * np.uint32(0x9E3779B1)) >> np.uint32(32 - GRAM_BITS)
    return bucket, np.searchsorted(place, at)


@dataclass
class LanguageModel:
    languages: list[str]
    log_p: np.ndarray
    """By language and bucket, per gram; divided by ``GRAM`` because as many grams share a byte."""


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums: dict[str, np.ndarray] = {}
    for batch in batches:
        for part in slices(batch, "text"):
            bucket, first = gram_buckets(*flat_text(column_of(part, "text")))
            for i, lang in enumerate(column_of(part, "lang").to_pylist()):
                own = sums.setdefault(lang, np.zeros(1 << GRAM_BITS, np.int64))
                own += np.bincount(bucket[first[i] : first[i + 1]], minlength=len(own))
    for lang, counts in sums.items():
        seen = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array([lang] * len(seen), pa.string()), pa.array(seen), pa.array(counts[seen])],
            names=["lang", "bucket", "n"],
        )


def learn_languages(
    labelled: DataFrame, text: str = "text", lang: str = "lang", most_languages: int = 1000
) -> LanguageModel:
    """Counts grams over all rows with a label; rows without text count for nothing.

    More than ``most_languages`` distinct labels are refused: the model grows with them.
    """
    rows = labelled.select(F.lower(F.col(text)).alias("text"), F.col(lang).alias("lang"))
    rows = rows.filter(F.col("lang").isNotNull() & F.col("text").isNotNull())
    counts = (
        in_batches(rows)
        .mapInArrow(_count, "lang string, bucket long, n long")
        .groupBy("lang", "bucket")
        .agg(F.sum("n").alias("n"))
    )
    found = counts.limit((most_languages << GRAM_BITS) + 1).toArrow()
    languages = sorted(set(found["lang"].to_pylist()))
    if len(languages) > most_languages:
        raise ValueError(f"more than {most_languages} languages among the labels")
    table = np.zeros((len(languages), 1 << GRAM_BITS))
    place = {lang: i for i, lang in enumerate(languages)}
    row = [place[lang] for lang in found["lang"].to_pylist()]
    table[row, found["bucket"].to_numpy()] = found["n"].to_numpy()
    table += 0.5
    log_p = np.log(table / table.sum(axis=1, keepdims=True)) / GRAM
    return LanguageModel(languages, log_p.astype(np.float32))


def _by_row(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums over the rows' parts of the first axis; rows without any get 0."""
    if len(values) == 0:
        return np.zeros((len(first) - 1, *values.shape[1:]))
    sums = np.add.reduceat(values, np.minimum(first[:-1], len(values) - 1), axis=0)
    sums[np.diff(first) == 0] = 0
    return sums


def unit_likelihoods(
    model: LanguageModel, bucket: np.ndarray, first: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Log-likelihood of each unit by language, grams of each unit, and where rows' units begin."""
    n_grams = np.diff(first)
    n_units = -(-n_grams // UNIT)
    unit_first = np.concatenate([[0], np.cumsum(n_units)])
    within = np.arange(unit_first[-1]) - np.repeat(unit_first[:-1], n_units)
    starts = np.repeat(first[:-1], n_units) + UNIT * within
    sizes = np.diff(np.append(starts, len(bucket)))
    if len(starts) == 0 or not model.languages:
        return np.zeros((len(starts), len(model.languages))), sizes, unit_first
    columns = [np.add.reduceat(p[bucket], starts) for p in model.log_p]
    return np.stack(columns, axis=1).astype(np.float64), sizes, unit_first


def _shares(ratio: np.ndarray, shares: np.ndarray, n_units: np.ndarray, rounds: int):
    """Expectation-maximisation for all rows at once; shares of 0 stay 0."""
    first = np.concatenate([[0], np.cumsum(n_units)])
    for _ in range(rounds):
        joint = ratio * np.repeat(shares, n_units, axis=0)
        joint /= joint.sum(axis=1, keepdims=True)
        new = _by_row(joint, first) / n_units[:, None]
        moved = np.abs(new - shares).max()
        shares = new
        if moved < 1e-4:
            break
    return shares


def infer_mixture(
    model: LanguageModel,
    units: np.ndarray,
    sizes: np.ndarray,
    first: np.ndarray,
    penalty: float = 1.0,
    rounds: int = 30,
) -> tuple[np.ndarray, np.ndarray]:
    """The share of each language in the grams of each row, zeros for rows without grams; and by how
    much the mixture's log-likelihood per gram exceeds that of grams that are all equally likely."""
    n_rows, n_langs = len(first) - 1, units.shape[1]
    out = np.zeros((n_rows, n_langs))
    n_units = np.diff(first)
    rows = np.flatnonzero(n_units)
    if len(rows) == 0 or n_langs == 0:
        return out, np.zeros(n_rows)
    top = units.max(axis=1)
    ratio = np.exp(units - top[:, None])
    shares = np.zeros((n_rows, n_langs))
    best = _by_row(units, first).argmax(axis=1)
    shares[np.arange(n_rows), best] = 1.0
    fit = np.zeros(n_rows)
    alone = np.repeat(best, n_units)
    fit[:] = _by_row((units[np.arange(len(units)), alone] - top)[:, None], first)[:, 0]
    active = rows
    for _ in range(n_langs - 1):
        if len(active) == 0:
            break
        own_units = n_units[active]
        chosen = np.repeat(first[active], own_units) + _within(own_units)
        own = ratio[chosen]
        starts = np.concatenate([[0], np.cumsum(own_units)])
        mixed = np.maximum((own * np.repeat(shares[active], own_units, axis=0)).sum(axis=1), 1e-300)
        rise = _by_row(own / mixed[:, None], starts) / own_units[:, None]
        rise[shares[active] > 0] = 0
        joins = rise.argmax(axis=1)
        grows = rise[np.arange(len(active)), joins] > 1
        if not grows.any():
            break
        keep = np.repeat(grows, own_units)
        active, own, own_units, joins = active[grows], own[keep], own_units[grows], joins[grows]
        starts = np.concatenate([[0], np.cumsum(own_units)])
        trial = shares[active] * 0.9
        trial[np.arange(len(active)), joins] = 0.1
        trial = _shares(own, trial, own_units, rounds)
        mixed = (own * np.repeat(trial, own_units, axis=0)).sum(axis=1)
        gained = _by_row(np.log(np.maximum(mixed, 1e-300))[:, None], starts)[:, 0]
        better = gained - fit[active] > penalty * 0.5 * np.log(np.maximum(own_units, 2))
        shares[active[better]] = trial[better]
        fit[active[better]] = gained[better]
        active = active[better]
    joint = ratio * np.repeat(shares, n_units, axis=0)
    joint *= (sizes / np.maximum(joint.sum(axis=1), 1e-300))[:, None]
    out = _by_row(joint, first)
    total = out.sum(axis=1, keepdims=True)
    likelihood = fit + _by_row(top[:, None], first)[:, 0]
    grams = np.maximum(_by_row(sizes[:, None].astype(np.float64), first)[:, 0], 1)
    gain = np.where(n_units > 0, likelihood * GRAM / grams + GRAM_BITS * np.log(2), 0.0)
    return np.divide(out, total, out=np.zeros_like(out), where=total > 0), gain


def _within(counts: np.ndarray) -> np.ndarray:
    return np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)


def identify_languages(
    docs: DataFrame,
    model: LanguageModel,
    keep: list[str],
    text: str = "text",
    penalty: float = 1.0,
) -> DataFrame:
    """The columns ``keep`` with ``lang_pred``, ``score`` (its share), ``shares`` (language, share; largest
    first), ``gain`` and ``n_grams`` of every row. The gain is the log-likelihood per gram above that of
    grams that are all equally likely; texts in none of the learned languages have a negative one.

    - Texts that are null or have no letter are ``und`` with score and gain 0 and no shares; so is every text if
      nothing was learned. Ties go to the language that comes first in code point order.
    - Repeated rows get the same result. Texts of any length are used as a whole.
    - An empty table gives an empty table; kept columns may have any names (see ``rows.scan``).
    """
    shared = docs.sparkSession.sparkContext.broadcast(vars(model))

    def work(part: pa.RecordBatch) -> list[pa.Array]:
        known = LanguageModel(**shared.value)
        grams, first = gram_buckets(*flat_text(part.column(part.num_columns - 1)))
        units, sizes, unit_first = unit_likelihoods(known, grams, first)
        shares, gain = infer_mixture(known, units, sizes, unit_first, penalty)
        preds, scores, lists = [], [], []
        for own in shares:
            order = [i for i in np.argsort(-own, kind="stable").tolist() if own[i] > 0]
            preds.append(known.languages[order[0]] if order else UNKNOWN)
            scores.append(float(own[order[0]]) if order else 0.0)
            lists.append([{"lang": known.languages[i], "share": float(own[i])} for i in order])
        kind = pa.list_(pa.struct([("lang", pa.string()), ("share", pa.float64())]))
        return [
            pa.array(preds, pa.string()),
            pa.array(scores, pa.float64()),
            pa.array(lists, kind),
            pa.array(gain),
            pa.array(np.diff(first)),
        ]

    # A text without a letter is handed on as empty: bytes outside ASCII need not be letters.
    body = F.col(f"`{text}`")
    letters = F.when(body.rlike(r"\p{L}"), F.lower(body)).otherwise(F.lit(""))
    fields = (
        "lang_pred string; score double; shares array<struct<lang:string,share:double>>; "
        "gain double; n_grams long"
    )
    return scan(docs, keep, letters, work, fields, prefix="found_")
