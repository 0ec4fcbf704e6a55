"""Mixing sources to target weights (operator 5): capped water-filling, DataFrame operations only.

1. Sizes per row are stored once (no texts), sizes per source are summed.
2. Water-filling over the table of sources: every source gets the level times its weight; sources
   above ``max_epochs`` times their size are clamped there and the level rises for the others. Sources
   are clamped in the order of cap by weight, so the level follows from one pass of running sums: it is
   that of the first source which it does not fill.
3. A target is some whole repetitions of its source and a fraction. The fraction is the first words of
   the source in a seeded order: whole documents, and of one document its first words. To find them no
   source is ever sorted as a whole: it is cut into about sqrt(n) buckets by the seeded hash, the
   buckets' sums are accumulated, and only the bucket in which the target ends is ordered.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wearlog.llm.rows import measured_bytes
from wearlog.session import stored

#: Rows of a table of sources that one task sums up in order, about.
ROWS_PER_TASK = 1_000_000
#: The digits of an MD5 sum that deal a row to a bucket (28 bits).
HEX_DIGITS = 7


def count_words(text: Column) -> Column:
    r"""Runs of anything but white space; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def running_sums(
    table: DataFrame, order: list[Column], before: dict[str, Column], rest: dict[str, Column]
) -> DataFrame:
    """The table with the sums of ``before`` over the rows that precede a row in the ``order``, and of
    ``rest`` over the row and all that follow; stored.

    The table is cut into ranges of the order. One task sums up a range, and one the ranges' totals, of
    which there is one for each ``ROWS_PER_TASK`` rows.
    """
    parts = max(1, -(-table.count() // ROWS_PER_TASK))
    ranged = stored(
        table.repartitionByRange(parts, *order).withColumn("range", F.spark_partition_id()), "ranges"
    )
    totals = ranged.groupBy("range").agg(*[F.sum(x).alias(c) for c, x in {**before, **rest}.items()])
    earlier = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    later = Window.orderBy("range").rowsBetween(1, Window.unboundedFollowing)
    totals = totals.select(
        F.col("range").alias("r"),
        *[F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(f"{c}_out") for c in before],
        *[F.coalesce(F.sum(c).over(later), F.lit(0)).alias(f"{c}_out") for c in rest],
    )
    inside = Window.partitionBy("range").orderBy(*order)
    up = inside.rowsBetween(Window.unboundedPreceding, -1)
    down = inside.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    joined = ranged.join(measured_bytes(stored(totals, "range-totals")), F.col("range") == F.col("r"))
    return stored(
        joined.select(
            *table.columns,
            *[(F.col(f"{c}_out") + F.coalesce(F.sum(x).over(up), F.lit(0))).alias(c) for c, x in before.items()],
            *[(F.col(f"{c}_out") + F.sum(x).over(down)).alias(c) for c, x in rest.items()],
        ),
        "running",
    )


def water_fill(sources: DataFrame, share: float, max_epochs: float) -> DataFrame:
    """``sources`` (with ``source``, ``weight`` and ``source_size``) with ``target``.

    The targets sum up to ``share`` of all sizes, or to all caps if those are less. Sources without a
    positive weight, or of size 0, get 0.
    """
    cap = F.col("source_size") * F.lit(float(max_epochs))
    usable = (F.col("weight") > 0) & (F.col("source_size") > 0)
    total = float(sources.agg(F.sum("source_size").alias("n")).first()["n"] or 0) * share
    running = running_sums(
        sources.filter(usable),
        [(cap / F.col("weight")).asc(), F.col("source").asc_nulls_last()],
        {"clamped": cap},
        {"open": F.col("weight").cast("double")},
    )
    level = (F.lit(total) - F.col("clamped")) / F.col("open")
    # The sums grow with the order, so the least one tells the first source that is not filled.
    found = (
        running.withColumn("level", level)
        .filter(cap > F.col("level") * F.col("weight"))
        .agg(F.min_by("level", "clamped").alias("level"))
        .first()["level"]
    )
    filled = cap if found is None else F.least(cap, F.lit(found) * F.col("weight"))
    return sources.withColumn("target", F.when(usable, filled).otherwise(F.lit(0.0)))


def mix_sources(
    docs: DataFrame,
    weights: DataFrame | None = None,
    share: float = 1.5,
    max_epochs: float = 2.0,
    seed: str = "mix",
    id: str = "doc_id",
    source: str = "source",
    text: str = "text",
) -> DataFrame:
    """``doc_id, size, source_size, target, taken`` and ``source`` for every row of ``docs``.

    ``weights``: a table (source, weight) with one row per source, null included; by default the
    sources in order of their code points, null last, weigh 5, 2, 1 in turn. Sources that it lacks
    weigh 0. The table of sources is small next to the documents, but never collected.

    ``taken`` is the number of words the mix takes of a row: its whole repetitions, plus, for rows
    within the seeded fraction, all its words, plus, for the row in which the target ends, its first
    words. The words taken from a source sum up to its target, rounded to a whole number.

    - Null texts and texts of white space have size 0 and nothing is taken of them.
    - Null sources are one source. Null ids are ordered like an empty id.
    - Rows that agree in id, size and source are interchangeable; each is counted. The seeded order
      depends on seed, id and size alone, so reruns agree.
    - An empty table gives an empty table; other columns are not looked at.
    """
    order = F.md5(F.concat_ws(":", F.lit(seed), F.coalesce(F.col(id).cast("string"), F.lit(""))))
    sized = stored(
        docs.select(
            F.col(id).alias("doc_id"),
            F.col(source).cast("string").alias("source"),
            count_words(F.col(text)).alias("size"),
            order.alias("place"),
        ),
        "sizes",
    )
    sources = sized.groupBy("source").agg(
        F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n")
    )
    if weights is None:
        order = [F.col("source").asc_nulls_last()]
        placed = running_sums(stored(sources, "source-sizes"), order, {"place": F.lit(1)}, {})
        fixed = F.array(*map(F.lit, (5, 2, 1)))
        weighted = placed.withColumn(
            "weight", F.element_at(fixed, (F.col("place") % 3 + 1).cast("int"))
        ).drop("place")
    else:
        known = weights.select(
            F.col(weights.columns[0]).alias("s"), F.col(weights.columns[1]).alias("weight")
        )
        weighted = sources.join(known, F.col("source").eqNullSafe(F.col("s")), "left").drop("s")
        weighted = weighted.withColumn("weight", F.coalesce("weight", F.lit(0)))
    weighted = stored(weighted, "sources")
    whole = F.floor(F.col("target") / F.col("source_size"))
    plan = (
        water_fill(weighted, share, max_epochs)
        .withColumn("whole", F.when(F.col("source_size") > 0, whole).otherwise(0).cast("long"))
        .withColumn("extra", F.round("target").cast("long") - F.col("whole") * F.col("source_size"))
        .withColumn("buckets", F.ceil(F.sqrt("n")))
        .select("source", "source_size", "target", "whole", "extra", "buckets")
    )
    plan = stored(plan, "targets")
    span = F.conv(F.substring("place", 1, HEX_DIGITS), 16, 10).cast("long")
    bucket = F.floor(span * F.col("buckets") / F.lit(16**HEX_DIGITS))
    rows = sized.join(
        measured_bytes(plan), sized["source"].eqNullSafe(plan["source"])
    ).select(sized["*"], *[c for c in plan.columns if c != "source"], bucket.alias("bucket"))
    sums = rows.groupBy("source", "bucket", "extra").agg(F.sum("size").alias("bucket_size"))
    ordered = Window.partitionBy("source").orderBy("bucket")
    sums = sums.select(
        F.col("source").alias("s"),
        F.col("bucket").alias("b"),
        "bucket_size",
        (F.sum("bucket_size").over(ordered) - F.col("bucket_size")).alias("before"),
    )
    # Of each source the bucket in which its extra words end.
    ends = (
        sums.join(plan.select(F.col("source").alias("p"), "extra"), F.col("s").eqNullSafe(F.col("p")))
        .filter((F.col("before") < F.col("extra")) & (F.col("before") + F.col("bucket_size") >= F.col("extra")))
        .select("s", F.col("b").alias("last"), F.col("before").alias("last_before"))
    )
    ends = stored(ends, "last-buckets")
    ended = rows.join(
        measured_bytes(ends),
        rows["source"].eqNullSafe(ends["s"]),
        "left",
    ).drop("s")
    is_last = F.coalesce(F.col("bucket") == F.col("last"), F.lit(False))
    base = F.col("whole") * F.col("size")
    # No extra words at all: no last bucket either.
    within = F.when(F.col("bucket") < F.col("last"), F.col("size")).otherwise(F.lit(0))
    output = ["doc_id", "source", "size", "source_size", "target"]
    simple = ended.filter(~is_last).select(*output, (base + within).cast("long").alias("taken"))
    running = Window.partitionBy("source").orderBy("place", "size").rowsBetween(
        Window.unboundedPreceding, -1
    )
    before = F.col("last_before") + F.coalesce(F.sum("size").over(running), F.lit(0))
    part = F.greatest(F.lit(0), F.least(F.col("size"), F.col("extra") - before))
    cut = ended.filter(is_last).select(*output, (base + part).cast("long").alias("taken"))
    return simple.unionByName(cut)

