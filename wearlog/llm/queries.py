"""The registered queries of the operators, their SQL where SQL can express them."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wearlog.llm.decontaminate import find_contamination
from wearlog.llm.language import identify_languages, learn_languages
from wearlog.llm.licences import TEMPLATES, scan_licences
from wearlog.llm.lines import drop_common_lines
from wearlog.llm.mixing import mix_sources
from wearlog.llm.near_dup import near_duplicates
from wearlog.llm.quality import COUNTS, judge_quality
from wearlog.llm.repair import damaged, repair_summary
from wearlog.llm.passages import short_passages
from wearlog.llm.repeats import drop_repeats, repeated_spans
from wearlog.llm.rows import DOC, join, measured, read
from wearlog.llm.tokens import attribute_tokens
from wearlog.llm.topk import top_k
from wearlog.llm.toxicity import learn_toxicity, score_toxicity
from wearlog.llm.trie import numbered_turns, prefix_trie, with_ends_digest, with_heads
from wearlog.session import stored


def remainder(parts: int) -> Column:
    """Of the check sum of the id as text; a null id counts as remainder 0."""
    return F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(parts)), F.lit(0))


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    model = learn_languages(docs.filter(remainder(4) != 2))
    found = identify_languages(docs, model, ["doc_id"])
    held_out = (remainder(4) == 2).alias("held_out")
    return found.select("doc_id", held_out, "lang_pred", "score", "shares", "gain")


def op2_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read(spark, sf_dir, "documents")).drop("text_key", "class_key")


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    labels = read(spark, sf_dir, "labels").filter(remainder(5) != 0)
    scored = score_toxicity(docs, learn_toxicity(docs, labels), ["doc_id"])
    return scored.select(
        "doc_id",
        (remainder(5) == 0).alias("held_out"),
        "score",
        F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"),
        F.size("hits").alias("n_hits"),
    )


def op4_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan_licences(read(spark, sf_dir, "documents"), ["doc_id"])
    base = F.filter("matches", lambda m: m["base"])
    starts = F.transform(base, lambda m: m["start"])
    joined = lambda some: F.array_join(  # noqa: E731
        F.array_sort(F.array_distinct(F.transform(some, lambda m: m["label"]))), ","
    )
    return found.select(
        "doc_id",
        "n_words",
        F.size(base).cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        joined(base).alias("base_labels"),
        joined(F.col("matches")).alias("labels"),
        F.round(
            F.coalesce(F.array_max(F.transform("matches", lambda m: m["cover"])), F.lit(0.0)), 6
        ).alias("score"),
    )


def _licence_sql() -> str:
    words = ", ".join(
        f"({t}, {off}, '{word}', {off in set(template.mandatory)})"
        for t, template in enumerate(TEMPLATES)
        for off, word in enumerate(template.words)
    )
    templates = ", ".join(
        f"({t}, '{x.label}', {x.base}, {len(x.words)}, {x.needed}, {len(x.mandatory)})"
        for t, x in enumerate(TEMPLATES)
    )
    return rf"""
    WITH parts(t, off, word, must) AS (VALUES {words}),
    templates(t, label, base, size, needed, musts) AS (VALUES {templates}),
    split AS (
        SELECT doc_id, regexp_extract_all(
                   translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                   '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
        FROM documents),
    places AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) - 1 AS pos FROM split),
    aligned AS (
        SELECT doc_id, t, pos - off AS start, count(*) AS n, count(*) FILTER (must) AS n_must
        FROM places JOIN parts USING (word) GROUP BY ALL),
    matches AS (
        SELECT doc_id, start, label, base, n / size AS cover
        FROM aligned JOIN templates USING (t) JOIN split USING (doc_id)
        WHERE n >= needed AND n_must = musts AND start >= 0 AND start + size <= len(w)),
    found AS (
        SELECT doc_id, count(*) FILTER (base) AS n_base, min(start) FILTER (base) AS first_word,
               max(start) FILTER (base) AS last_word,
               string_agg(DISTINCT label, ',' ORDER BY label) FILTER (base) AS base_labels,
               string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(cover) AS score
        FROM matches GROUP BY doc_id)
    SELECT doc_id, len(w) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
           coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
           round(coalesce(score, 0), 6) AS score
    FROM split LEFT JOIN found USING (doc_id)"""


def op5_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix_sources(read(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


MIX_SQL = r"""
    WITH sized AS (
        SELECT doc_id, source, md5(concat('mix:', doc_id)) AS place,
               len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size
        FROM documents),
    sources AS (
        SELECT *, [5, 2, 1][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT] AS w
        FROM (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source)),
    ranked AS (
        SELECT *, 2.0::DOUBLE * source_size AS cap,
               row_number() OVER (ORDER BY 2.0::DOUBLE * source_size / w, source NULLS LAST) AS k
        FROM sources WHERE source_size > 0),
    levels AS (
        SELECT k, cap, w,
               (1.5::DOUBLE * sum(cap) OVER () / 2
                   - coalesce(sum(cap) OVER (ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
               / (sum(w) OVER (ORDER BY k ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::DOUBLE AS level
        FROM ranked),
    chosen AS (SELECT level FROM levels WHERE cap > level * w ORDER BY k LIMIT 1),
    targets AS (
        SELECT source, source_size,
               CASE WHEN source_size > 0
                    THEN least(2.0::DOUBLE * source_size, level * w) ELSE 0 END AS target
        FROM sources, chosen),
    plan AS (
        SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END::BIGINT AS whole
        FROM targets),
    placed AS (
        SELECT doc_id, size, source_size, target, whole,
               round(target)::BIGINT - whole * source_size AS extra,
               coalesce(sum(size) OVER (PARTITION BY sized.source ORDER BY place, size
                        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
        FROM sized JOIN plan ON sized.source IS NOT DISTINCT FROM plan.source)
    SELECT doc_id, size::BIGINT AS size, source_size, target,
           (whole * size + greatest(0, least(size, extra - before)))::BIGINT AS taken
    FROM placed"""


VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"


def op6_token_counts(
    spark: SparkSession, sf_dir: str, vocabulary: str = VOCABULARY
) -> DataFrame:
    """Tokens of source, language and text, and of each of their lines, encoded as one document."""
    fields = ["source", "lang", "text"]
    counted = attribute_tokens(read(spark, sf_dir, "documents"), vocabulary, ["doc_id"], fields)
    tokens = lambda name: F.aggregate(  # noqa: E731
        F.filter("sections", lambda s: s["field"] == name),
        F.lit(0).cast("long"),
        lambda total, s: total + s["n_tokens"],
    ).alias(f"{name}_tokens")
    return counted.select(
        "doc_id",
        "n_tokens",
        "n_crossing",
        *[tokens(name) for name in fields],
        F.transform("sections", lambda s: s["n_tokens"]).alias("section_tokens"),
    )


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contract's columns, then passages of over 50 words that another document holds in rows that lose
    nothing, as these passages can be shorter than 400 bytes, and whether a row holds either."""
    docs = read(spark, sf_dir, "documents")
    spans = stored(repeated_spans(docs, 400, "doc_id", "text"), "spans")
    cut = drop_repeats(docs, 400, spans=spans)
    lost = F.aggregate(
        "removed", F.lit(0).cast("long"), lambda total, run: total + run["end"] - run["start"]
    )
    rows = cut.select(
        *DOC,
        (F.octet_length("kept") + lost).cast("long").alias("n_bytes"),
        lost.alias("n_removed"),
        F.size("removed").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )
    passages = stored(short_passages(docs, spans.select(*DOC), n_words=51), "passages")
    found = join(rows, measured(passages), DOC, "left").drop("text_key")
    words = F.coalesce("n_passage_words", F.lit(0))
    repeated = (F.col("n_removed") > 0) | (words > 0)
    return found.withColumns({"n_passage_words": words, "repeated": repeated})


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_contamination(
        read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"), n=10, slop=2
    )
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        "n_items",
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
        "n_near",
    )


DECONTAMINATE_SQL = r"""
    WITH doc_words AS (
        SELECT doc_id, regexp_extract_all(
                   translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                   '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
        FROM documents),
    items AS (
        SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(
                   translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                   '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
        FROM benchmark),
    grams AS (
        SELECT DISTINCT item, array_to_string(w[i:i + 9], ' ') AS g, least(len(w), 10) AS n
        FROM (SELECT item, w, unnest(range(1, greatest(1, len(w) - 9) + 1)) AS i
              FROM items WHERE len(w) > 0)),
    lengths AS (SELECT DISTINCT n FROM grams),
    places AS (
        SELECT doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS g
        FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM doc_words), lengths
        WHERE i + n - 1 <= len(w)),
    found AS (SELECT doc_id, i, places.n, item, g FROM places JOIN grams USING (g)),
    hits AS (
        SELECT doc_id, count(DISTINCT p) AS n_hit
        FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM found) GROUP BY doc_id),
    words AS (SELECT doc_id, unnest(w) AS term, generate_subscripts(w, 1) - 1 AS pos FROM doc_words),
    counts AS (SELECT term, count(*) AS n_places FROM words GROUP BY term),
    parts AS (
        SELECT g, n, unnest(string_split(g, ' ')) AS term, generate_subscripts(string_split(g, ' '), 1) - 1 AS off
        FROM (SELECT DISTINCT g, n FROM grams)),
    rarest AS (
        SELECT g, n, arg_min(term, (n_places, off)) AS term, arg_min(off, (n_places, off)) AS off
        FROM parts JOIN counts USING (term) GROUP BY g, n HAVING count(*) = n),
    starts AS (
        SELECT doc_id, g, n, pos - off AS start FROM words JOIN rarest USING (term) WHERE pos >= off
        EXCEPT SELECT doc_id, g, n, i - 1 FROM found),
    near AS (
        SELECT doc_id, count(*) AS n_near
        FROM (SELECT starts.doc_id, starts.g, start
              FROM starts JOIN parts USING (g) JOIN words
                ON words.doc_id = starts.doc_id AND words.term = parts.term
               AND words.pos BETWEEN start + off - 2 AND start + off + 2
              GROUP BY starts.doc_id, starts.g, starts.n, start HAVING count(DISTINCT off) = starts.n)
        GROUP BY doc_id),
    by_doc AS (
        SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
        FROM (SELECT DISTINCT doc_id, item FROM found) GROUP BY doc_id)
    SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
           sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated,
           coalesce(n_near, 0) AS n_near
    FROM doc_words LEFT JOIN hits USING (doc_id) LEFT JOIN by_doc USING (doc_id)
    LEFT JOIN near USING (doc_id)"""


def op9_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    whole = F.transform("embedding", lambda x: F.floor(F.lit(256.0) * x.cast("double")).cast("double"))
    fine = F.forall(
        "embedding",
        lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))),
    )
    vectors = read(spark, sf_dir, "embeddings").filter(fine).select("vec_id", whole.alias("vector"))
    found = top_k(vectors, vectors.filter(F.col("vec_id") % 50 == 0), k=5)
    return found.select(
        "query_id", "rank", F.col("id").alias("vec_id"), F.col("score").cast("long").alias("score")
    )


TOP_K_SQL = """
    WITH vectors AS (
        SELECT vec_id, list_transform(embedding, lambda x: floor(256.0::DOUBLE * x::DOUBLE)) AS v
        FROM embeddings
        WHERE len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    scored AS (
        SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.v, c.v) AS score
        FROM vectors q JOIN vectors c ON q.vec_id <> c.vec_id AND q.vec_id % 50 = 0)
    SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, CAST(score AS BIGINT) AS score
    FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank
          FROM scored)
    WHERE rank <= 5"""


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = drop_common_lines(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return kept.select(
        "doc_id",
        "n_lines",
        "n_dropped",
        F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"),
    )


LINE_DEDUP_SQL = r"""
    WITH lines AS (
        SELECT doc_id, line, i,
               translate(trim(line, E' \t\n\x0b\x0c\r'),
                         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
        FROM (SELECT doc_id, unnest(l) AS line, generate_subscripts(l, 1) AS i
              FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents))),
    common AS (
        SELECT k, max(doc_id) AS keeper FROM lines WHERE length(k) >= 20
        GROUP BY k HAVING count(DISTINCT doc_id) >= 3),
    marked AS (
        SELECT doc_id, line, i, keeper IS NOT NULL AND keeper <> doc_id AS gone
        FROM lines LEFT JOIN common USING (k))
    SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
           sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), ''))
               AS kept_sha256
    FROM marked GROUP BY doc_id"""

def _check_sum(text: str) -> str:
    """SQL for CRC-32 of an ASCII text, bit by bit."""
    step = "CASE WHEN (v & 1) = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END"
    return f"""xor(list_reduce(
        list_transform(string_split({text}, ''), lambda x: ascii(x)::BIGINT),
        lambda c, b: list_reduce(range(8), lambda v, k: {step}, xor(c, b)),
        4294967295::BIGINT), 4294967295::BIGINT)"""


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The conversations as rebuilt: the first turns come from the family's first conversation."""
    conversations = read(spark, sf_dir, "conversations")
    numbered = stored(numbered_turns(conversations), "numbered-turns")
    ids = stored(numbered.select("conv_id").distinct(), "conversations")
    family = F.col("conv_id") - F.col("conv_id") % 20
    heads = F.crc32(F.col("conv_id").cast("string")) % 4
    trie = prefix_trie(with_heads(numbered, ids, family, heads, most=3), ids)
    return with_ends_digest(trie).select(
        "conv_id",
        "depth",
        "parent_conv_id",
        "n_convs",
        "n_children",
        "n_leaves",
        "saved_tokens",
        "ends_sha256",
    )


PREFIX_TRIE_SQL = rf"""
    WITH numbered AS (
        SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) - 1 AS pos,
               concat(md5(coalesce(role, '')), md5(coalesce(text, ''))) AS k,
               len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS w
        FROM conversations WHERE conv_id IS NOT NULL),
    ids AS (
        SELECT DISTINCT conv_id, conv_id - conv_id % 20 AS family, {_check_sum("conv_id::VARCHAR")} % 4 AS h
        FROM numbered),
    rebuilt AS (
        SELECT ids.conv_id, 0 AS own, pos, k, w FROM ids JOIN numbered ON numbered.conv_id = family AND pos < h
        UNION ALL
        SELECT conv_id, 1, pos, k, w FROM ids JOIN numbered USING (conv_id) WHERE pos >= h),
    paths AS (
        SELECT conv_id, w, row_number() OVER placed AS depth, md5(string_agg(k, '') OVER placed) AS path
        FROM rebuilt WINDOW placed AS (PARTITION BY conv_id ORDER BY own, pos)
        UNION ALL SELECT conv_id, 0, 0, '' FROM ids),
    stays AS (
        SELECT *, lag(path) OVER (PARTITION BY conv_id ORDER BY depth) AS up,
               depth = max(depth) OVER (PARTITION BY conv_id) AS last
        FROM paths),
    nodes AS (
        SELECT path, depth, any_value(up) AS up, any_value(w) AS w, min(conv_id) AS conv_id, count(*) AS n_convs,
               string_agg(conv_id, ',' ORDER BY conv_id) FILTER (last) AS ends
        FROM stays GROUP BY path, depth),
    marked AS (
        SELECT nodes.*, coalesce(n_children, 0) AS n_children FROM nodes LEFT JOIN (
            SELECT up AS path, count(*) AS n_children FROM nodes GROUP BY up) USING (path)),
    sums AS (
        SELECT above.path, above.depth, count(*) FILTER (n_children = 0) AS n_leaves,
               sum((n_convs - 1) * marked.w)::BIGINT AS saved_tokens
        FROM marked JOIN stays above ON above.conv_id = marked.conv_id AND above.depth <= marked.depth
        GROUP BY above.path, above.depth)
    SELECT marked.conv_id, marked.depth, parents.conv_id AS parent_conv_id, marked.n_convs, n_children,
           n_leaves, saved_tokens, sha256(coalesce(marked.ends, '')) AS ends_sha256
    FROM marked JOIN sums USING (path, depth) LEFT JOIN nodes parents ON parents.path = marked.up"""


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = read(spark, sf_dir, "conversations")
    named = lambda name: F.coalesce(F.col(name).cast("string"), F.lit(" "))  # noqa: E731
    key = F.crc32(F.concat(named("conv_id"), F.lit(":"), named("turn"))) % 20
    return repair_summary(damaged(turns, key), turns.select("conv_id")).drop("rows")


def _repair_sql() -> str:
    def edit(letter: str, cost: str, state: str, line: str = "") -> str:
        lines = f"list_prepend({line}, {state}.t)" if line else f"{state}.t"
        return f"{{'c': {state}.c + {cost}, 'a': '{letter}' || {state}.a, 't': {lines}}}"

    new = lambda state, role: edit("I", "3", state, f"'{role}:'")  # noqa: E731
    extra = "CASE WHEN fault = 3 THEN 3 ELSE 0 END"
    leads = [{"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2}]
    own = []
    for state, ways in enumerate(leads):
        to, role = (3, "assistant") if state == 2 else (2, "user")
        kept = " ".join(
            f"WHEN fault NOT IN (1, 2) AND role[1] = '{initial}' THEN "
            + edit("K", f"({extra})", f"s{way}", "concat(role, ':', text)")
            for initial, way in ways.items()
        )
        changed = edit("R", f"(3 + {extra})", f"s{to}", f"concat('{role}:', text)")
        gone = edit("D", "4", f"s{state}")
        own.append(
            f"least({gone}, CASE {kept} ELSE {gone} END, "
            f"CASE WHEN fault NOT IN (1, 2) THEN {changed} ELSE {gone} END) AS w{state}"
        )
    return rf"""
    WITH RECURSIVE given AS (
        SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
               {_check_sum("concat(coalesce(conv_id::VARCHAR, ' '), ':', coalesce(turn::VARCHAR, ' '))")} % 20 AS kind
        FROM conversations),
    spoiled AS (
        SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
               CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
        FROM (SELECT *, unnest(range(CASE kind WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) FROM given)),
    numbered AS (
        SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST) AS again,
               right(rtrim(text, E' 	

'), 1) AS last
        FROM spoiled),
    turns AS (
        SELECT conv_id, turn, role, text,
               CASE WHEN last = '' THEN 1 WHEN again > 1 THEN 2 WHEN last NOT IN ('.', '!', '?') THEN 3 ELSE 0
               END AS fault,
               row_number() OVER (PARTITION BY conv_id
                   ORDER BY turn DESC NULLS LAST, role DESC, text DESC, again DESC) AS i,
               role[1] || lag(role[1]) OVER (PARTITION BY conv_id
                   ORDER BY turn DESC NULLS LAST, role DESC, text DESC, again DESC) AS pair
        FROM numbered),
    counted AS (
        SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
               count(*) FILTER (fault = 1) AS blank, count(*) FILTER (fault = 2) AS duplicate,
               count(*) FILTER (fault = 3) AS truncated,
               count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal, max(i) AS n
        FROM turns GROUP BY conv_id),
    ways(conv_id, i, s0, s1, s2, s3) AS (
        SELECT conv_id, 0::BIGINT, {{'c': 0, 'a': '', 't': []::VARCHAR[]}},
               {{'c': 6, 'a': 'II', 't': ['user:', 'assistant:']}},
               {{'c': 3, 'a': 'I', 't': ['assistant:']}}, {{'c': 0, 'a': '', 't': []::VARCHAR[]}}
        FROM counted
        UNION ALL
        SELECT conv_id, i, least(w0, {new("v2", "user")}), least(w1, {new("v2", "user")}), v2, v3
        FROM (SELECT *, least(w2, {new("w3", "assistant")}) AS v2, least(w3, {new("w2", "user")}) AS v3
              FROM (SELECT ways.conv_id, turns.i, {", ".join(own)}
                    FROM ways JOIN turns
                      ON turns.conv_id IS NOT DISTINCT FROM ways.conv_id AND turns.i = ways.i + 1))),
    best AS (
        SELECT counted.*, s0 FROM counted JOIN ways
            ON ways.conv_id IS NOT DISTINCT FROM counted.conv_id AND ways.i = counted.n)
    SELECT ids.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0) AS blank,
           coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
           coalesce(illegal, 0) AS illegal, coalesce(s0.c, 0)::BIGINT AS cost, coalesce(s0.a, '') AS audit,
           sha256(coalesce(array_to_string(s0.t, chr(10)), '')) AS repaired_sha256
    FROM (SELECT DISTINCT conv_id FROM conversations) ids
    LEFT JOIN best ON best.conv_id IS NOT DISTINCT FROM ids.conv_id"""


def op13_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = judge_quality(read(spark, sf_dir, "documents"))
    return judged.select("doc_id", *COUNTS, "base_failed", "kept", "lost_words")


QUALITY_SQL = r"""
    WITH split AS (
        SELECT doc_id, source, coalesce(text, '') AS text,
               regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
        FROM documents),
    lines AS (
        SELECT doc_id, source, line, regexp_extract_all(
                   translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ123456789', 'abcdefghijklmnopqrstuvwxyz000000000'),
                   '[^\x20\x09-\x0D]+') AS k
        FROM (SELECT doc_id, source, unnest(string_split(text, chr(10))) AS line FROM split)),
    worded AS (SELECT * FROM lines WHERE len(k) > 0),
    hosts AS (SELECT source, count(DISTINCT doc_id) AS docs FROM split GROUP BY source),
    frequent AS (
        SELECT held.source, k FROM (
            SELECT source, k, count(DISTINCT doc_id) AS n FROM worded GROUP BY source, k) held
        JOIN hosts ON hosts.source IS NOT DISTINCT FROM held.source
        WHERE n > 10 OR (n >= 3 AND n > 0.5 * docs)),
    lost AS (
        SELECT doc_id, sum(len(worded.k))::BIGINT AS lost_words FROM worded JOIN frequent
            ON worded.k = frequent.k AND worded.source IS NOT DISTINCT FROM frequent.source
        GROUP BY doc_id),
    dup AS (
        SELECT doc_id, count(*) - count(DISTINCT line) AS n_dup_lines FROM worded GROUP BY doc_id),
    windows AS (
        SELECT doc_id, i, w[i:i + 2] AS g
        FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM split)),
    often AS (SELECT doc_id, g FROM windows GROUP BY doc_id, g HAVING count(*) > 1),
    repeated AS (
        SELECT doc_id, count(DISTINCT p) AS n_repeat_words
        FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM windows JOIN often USING (doc_id, g))
        GROUP BY doc_id),
    counted AS (
        SELECT doc_id, len(w) AS n_words,
               coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
               len(regexp_extract_all(text, '[#*$%&|<>]')) AS n_symbols,
               coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
               coalesce(lost_words, 0) AS lost_words
        FROM split LEFT JOIN dup USING (doc_id) LEFT JOIN repeated USING (doc_id)
        LEFT JOIN lost USING (doc_id)),
    judged AS (
        SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM counted)
    SELECT *, NOT base_failed AND n_words - lost_words >= 0.5 * n_words AS kept FROM judged"""


QUERIES = {
    query.__name__: query
    for query in [
        op1_language_id,
        op2_near_dedup,
        op3_toxicity,
        op4_licence_scan,
        op5_mix_sources,
        op6_token_counts,
        op7_suffix_dedup,
        op8_decontaminate,
        op9_top_k,
        op10_line_dedup,
        op11_prefix_trie,
        op12_conversation_repair,
        op13_quality_rules,
    ]
}
ORACLE_SQL = {
    "op4_licence_scan": _licence_sql(),
    "op5_mix_sources": MIX_SQL,
    "op8_decontaminate": DECONTAMINATE_SQL,
    "op9_top_k": TOP_K_SQL,
    "op10_line_dedup": LINE_DEDUP_SQL,
    "op11_prefix_trie": PREFIX_TRIE_SQL,
    "op12_conversation_repair": _repair_sql(),
    "op13_quality_rules": QUALITY_SQL,
}
