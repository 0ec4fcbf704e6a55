"""A corpus from raw documents to a weighted mix: each stage is one operator of ``wearlog.llm``.

``run`` applies the stages to ``documents``; every stage's result is written as Parquet into the
shared folder and read again as the next one's input, so a lost executor costs one stage at most.
Stages that filter pass each kept row on as it is; rows are named by their id and 64 bits of their text.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wearlog.llm.decontaminate import find_contamination
from wearlog.llm.language import identify_languages, learn_languages
from wearlog.llm.lines import drop_common_lines
from wearlog.llm.mixing import mix_sources
from wearlog.llm.near_dup import near_duplicates
from wearlog.llm.rows import DOC, join, measured, read, unused
from wearlog.session import scratch, scratch_path, stored


#: A text is in no learned language if its letter groups are e**100 times likelier at random.
EVIDENCE = 100


def _without(docs: DataFrame, keys: DataFrame) -> DataFrame:
    """The rows whose id and text hash are not among the stored ``keys``."""
    id, key = unused(docs, "row_id"), unused(docs, "row_key")
    marked = docs.withColumns({id: F.col("doc_id").cast("long"), key: F.xxhash64("text")})
    named = keys.select(F.col("doc_id").alias("id_"), F.col("text_key").alias("key_"))
    same = F.col(id).eqNullSafe(F.col("id_")) & (F.col(key) == F.col("key_"))
    return marked.join(measured(named), same, "left_anti").drop(id, key)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in no language go: those without a letter, and those far less likely under the languages
    learned from the labelled rows than if all letter groups were equally likely. ``lang`` stays. Where no
    language was learned, as ``lang`` is null in all rows with text, every document with a letter stays."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_key"), "text")
    found = identify_languages(rows, learn_languages(docs), DOC)
    # Without languages there is no gain either: it is 0.
    unknown = found.filter((F.col("n_grams") == 0) | (F.col("gain") * F.col("n_grams") < -EVIDENCE))
    return _without(docs, stored(unknown.select(*DOC).distinct(), "unknown"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that three documents or more hold stay in one of them; no document goes. ``n_chars`` follows
    the text."""
    kept = drop_common_lines(docs, counts=None)
    if "n_chars" not in docs.columns:
        return kept
    n_chars = F.char_length("text").cast(dict(docs.dtypes)["n_chars"])
    return kept.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(n_chars))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near duplicates the row with the smallest id stays; documents without words stay."""
    classes = near_duplicates(docs).filter((F.col("class_size") > 1) & F.col("class_key").isNotNull())
    classes = stored(classes, "classes")
    first = classes.groupBy("class_key").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("no"), *DOC)).alias("first")
    )
    firsts = first.select("first.doc_id", "first.text_key")
    others = stored(join(classes.select(*DOC).distinct(), firsts, DOC, "left_anti"), "others")
    kept = _without(docs, others)
    # Equal rows have the same key: one of them stays.
    twice = classes.groupBy(*DOC).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select(*DOC)
    twice = stored(twice, "equal-rows")
    if twice.isEmpty():
        return kept
    id, key = unused(docs, "row_id"), unused(docs, "row_key")
    marked = kept.withColumns({id: F.col("doc_id").cast("long"), key: F.xxhash64("text")})
    named = twice.select(F.col("doc_id").alias("id_"), F.col("text_key").alias("key_"))
    same = F.col(id).eqNullSafe(F.col("id_")) & (F.col(key) == F.col("key_"))
    equal = marked.join(measured(named), same, "left_semi").dropDuplicates([id, key]).drop(id, key)
    return _without(kept, twice).unionByName(equal)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold ten consecutive words of a benchmark item, or a whole shorter item, go."""
    found = find_contamination(docs, read(spark, sf_dir, "benchmark"), n=10)
    return _without(docs, stored(found.filter("n_hit > 0").select(*DOC).distinct(), "contaminated"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What the mix takes of each document: ``doc_id, source, size, source_size, target, taken``."""
    return mix_sources(docs)


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontaminate", decontaminate),
    ("mix_sources", mix),
]

#: Mixture inference and signatures have no counterpart in SQL; the tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, f"pipeline-{name}")
        # What a stage stores on its way is removed once its result is written.
        with scratch(spark):
            stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.schema(docs.schema).parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
