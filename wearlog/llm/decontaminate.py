"""Benchmark decontamination (operator 8): a positional inverted index, DataFrame operations only.

1. The benchmark's words are the test terms. One pass over the corpus stores the postings of test terms,
   ``(document, term, position)``, and one mark per document that carries its number of words.
2. Every window of an item (``n`` consecutive words, or all of a shorter item) is a phrase. Its lists are
   taken from the rarest term on, by the counts in the stored postings: positions of the rarest term,
   less its offset, are the candidate starts; the list of the second rarest, adjusted alike, leaves the
   survivors; the lists of all other words prove them.
3. Exact matches become hit positions and items per document.

Only rare lists and the postings of documents with survivors are ever joined. Sides are broadcast up to
``MOST_BROADCAST_BYTES``, measured, and joined by shuffle beyond; the results are the same.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wearlog.llm.rows import DOC, join, measured_bytes, words_of
from wearlog.session import stored

#: Stands for the end of a document among the postings; no word holds a blank.
END = " "


def keyed_words(docs: DataFrame, id: str, text: str) -> DataFrame:
    body = F.col(f"`{text}`")
    return docs.select(
        F.col(f"`{id}`").alias("doc_id"),
        F.coalesce(F.xxhash64(body), F.lit(0)).alias("text_key"),
        words_of(body).alias("words"),
    )


def store_postings(docs: DataFrame, terms: DataFrame, id: str, text: str) -> DataFrame:
    """``doc_id, text_key, term, pos`` of every place of a term, and per row of ``docs`` one posting of
    ``END`` at the number of its words."""
    places = keyed_words(docs, id, text).select(
        *DOC, F.posexplode(F.concat("words", F.array(F.lit(END)))).alias("pos", "word")
    )
    wanted = measured_bytes(terms.unionByName(terms.sparkSession.createDataFrame([(END,)], "term string")))
    postings = places.join(wanted, places["word"] == wanted["term"]).select(*DOC, "term", "pos")
    return stored(postings, "postings")


def windows_of(items: DataFrame, n: int, id: str = "item_id", text: str = "text") -> DataFrame:
    """``phrase`` (its words), ``item_id``: every window of every item, each once; stored."""
    words = items.select(
        F.col(f"`{id}`").cast("string").alias("item_id"), words_of(F.col(f"`{text}`")).alias("words")
    ).filter((F.size("words") > 0) & F.col("item_id").isNotNull())
    starts = F.sequence(F.lit(1), F.greatest(F.lit(1), F.size("words") - F.lit(n - 1)))
    phrases = words.select("item_id", F.explode(starts).alias("at"), "words").select(
        "item_id", F.slice("words", F.col("at"), n).alias("phrase")
    )
    return stored(phrases.distinct(), "windows")


def planned(windows: DataFrame, postings: DataFrame) -> DataFrame:
    """The windows all of whose words occur in the corpus, with their terms from the rarest on:
    ``key, n, lists`` (array of term and offset); ``windows`` holds a ``phrase`` once."""
    counts = (
        postings.filter(F.col("term") != END)
        .groupBy("term")
        .agg(F.count(F.lit(1)).alias("n_places"))
    )
    counts = stored(counts, "term-counts")
    key = F.array_join("phrase", " ").alias("key")
    spread = windows.select(key, F.posexplode("phrase").alias("off", "term"))
    ranked = (
        spread.join(measured_bytes(counts), "term")
        .groupBy("key")
        .agg(F.sort_array(F.collect_list(F.struct("n_places", "off", "term"))).alias("lists"))
    )
    whole = windows.select(key, F.size("phrase").alias("n"))
    return whole.join(ranked, "key").filter(F.size("lists") == F.col("n"))


def start_places(plan: DataFrame, postings: DataFrame) -> DataFrame:
    """``doc_id, text_key, key, n, start``: where windows would begin, judged by the places of their rarest
    word; stored."""
    first = plan.select(
        "key", "n", F.col("lists")[0]["term"].alias("term"), F.col("lists")[0]["off"].alias("off")
    )
    first = measured_bytes(stored(first, "rarest"))
    starts = (
        postings.join(first, "term")
        .select(*DOC, "key", "n", (F.col("pos") - F.col("off")).alias("start"))
        .filter("start >= 0")
    )
    # A row may stand there more than once: rows repeat, and so do their postings.
    return stored(starts.distinct(), "starts")


PLACE = [*DOC, "key", "n", "start"]


def matches_within(starts: DataFrame, plan: DataFrame, postings: DataFrame, slop: int) -> DataFrame:
    """``doc_id, text_key, key, n, start``: the ``starts`` at which every word of the window stands within
    ``slop`` places of its own place. The second-rarest word goes first; few starts are left for the others."""

    def near(rows: DataFrame, term: Column, off: Column) -> DataFrame:
        """A row for each place at which the word may stand."""
        pos = F.col("start") + off
        if slop:
            shifts = F.explode(F.sequence(F.lit(-slop), F.lit(slop)))
            rows = rows.select("*", shifts.alias("shift"))
            pos = pos + F.col("shift")
        return rows.select(*PLACE, term.alias("term"), off.alias("off"), pos.alias("pos"))

    second = plan.filter("n > 1").select(
        F.col("key").alias("k"), F.col("lists")[1]["term"].alias("t"), F.col("lists")[1]["off"].alias("o")
    )
    second = stored(second, "second-rarest")
    rare = postings.join(measured_bytes(second.select(F.col("t").alias("term")).distinct()), "term", "left_semi")
    probes = near(starts.join(measured_bytes(second), F.col("key") == F.col("k")), F.col("t"), F.col("o"))
    survivors = join(probes, rare, [*DOC, "term", "pos"], "left_semi").select(*PLACE)
    survivors = survivors.distinct() if slop else survivors
    survivors = stored(survivors.unionByName(starts.filter("n = 1").select(*PLACE)), "survivors")
    holders = stored(survivors.select(*DOC).distinct(), "holders")
    own = join(postings, measured_bytes(holders), DOC, "left_semi").distinct()
    others = plan.filter("n > 2").select(
        F.col("key").alias("k"), F.explode(F.slice("lists", 3, F.greatest(F.size("lists") - 2, F.lit(1)))).alias("list")
    )
    listed = survivors.filter("n > 2").join(measured_bytes(stored(others, "other-lists")), F.col("key") == F.col("k"))
    wanted = near(listed, F.col("list")["term"], F.col("list")["off"])
    proved = (
        join(wanted, own, [*DOC, "term", "pos"])
        .groupBy(*PLACE)
        .agg((F.count_distinct("off") if slop else F.count(F.lit(1))).alias("found"))
        .filter("found = n - 2")
        .drop("found")
    )
    return proved.unionByName(survivors.filter("n <= 2")).select(*PLACE)


def exact_matches(plan: DataFrame, postings: DataFrame) -> DataFrame:
    """``doc_id, text_key, key, n, start``: every place of every window."""
    return matches_within(start_places(plan, postings), plan, postings, 0)


def proximity_matches(plan: DataFrame, postings: DataFrame, slop: int) -> DataFrame:
    """The same with every word within ``slop`` places of its own, counted from a place of the rarest word."""
    return matches_within(start_places(plan, postings), plan, postings, slop)


def find_contamination(
    docs: DataFrame,
    items: DataFrame,
    n: int = 10,
    id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    slop: int | None = None,
) -> DataFrame:
    """``doc_id, text_key, n_words, n_hit, n_items, item_ids`` for every row of ``docs``.

    ``n_hit``: words inside a place of a window; ``item_ids``: sorted text ids of the items with a
    window that stands in the document. With a ``slop``, ``n_near`` counts the places of windows that do not
    stand there word for word, but with every word within ``slop`` places of its own.

    - Null and empty texts have no words; so have items, and those have no window. Items without an id
      are left out. Items with fewer than ``n`` words are one window as a whole.
    - Rows that agree in id and text get the same result, each its own row; rows that share only the id
      are told apart by a 64-bit hash of the text.
    - Empty tables give rows without hits, or no rows. Other columns are not looked at.
    """
    owned = windows_of(items, n, item_id, item_text)
    windows = stored(owned.select("phrase").distinct(), "phrases")
    terms = windows.select(F.explode("phrase").alias("term")).distinct()
    postings = store_postings(docs, stored(terms, "terms"), id, text)
    plan = stored(planned(windows, postings), "plan")
    starts = start_places(plan, postings)
    matches = stored(matches_within(starts, plan, postings, 0), "matches")
    hits = (
        matches.select(*DOC, F.explode(F.sequence(F.col("start"), F.col("start") + F.col("n") - 1)).alias("pos"))
        .distinct()
        .groupBy(*DOC)
        .agg(F.count(F.lit(1)).alias("n_hit"))
    )
    # A window that many items share is a row for each of them, so that no task holds it as a list.
    owners = owned.select(F.array_join("phrase", " ").alias("key"), F.col("item_id").alias("item"))
    owners = stored(owners.join(plan.select("key"), "key", "left_semi"), "owners")
    found = (
        stored(matches.select(*DOC, "key").distinct(), "doc-windows")
        .join(measured_bytes(owners), "key")
        .groupBy(*DOC)
        .agg(F.sort_array(F.collect_set("item")).alias("item_ids"))
    )
    ends = postings.filter(F.col("term") == END).select(*DOC, F.col("pos").cast("long").alias("n_words"))
    per_doc = stored(join(hits, found, DOC), "hits")
    more = []
    if slop is not None:
        rest = join(starts, matches.select(*DOC, "key", "start"), [*DOC, "key", "start"], "left_anti")
        near = matches_within(stored(rest, "other-starts"), plan, postings, slop)
        near = stored(near.groupBy(*DOC).agg(F.count(F.lit(1)).alias("n_near")), "near")
        ends = join(ends, measured_bytes(near), DOC, "left")
        more = [F.coalesce("n_near", F.lit(0)).alias("n_near")]
    return join(ends, measured_bytes(per_doc), DOC, "left").select(
        *DOC,
        "n_words",
        F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce(F.size("item_ids"), F.lit(0)).cast("long").alias("n_items"),
        F.coalesce("item_ids", F.array().cast("array<string>")).alias("item_ids"),
        *more,
    )
