"""The registered queries of the numbered operators, on whole tables, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat_format, exact_dedup, hard_negatives, jaccard_join, katz, mixing, nbest_pieces, periodic_runs, quality_classifier, quality_rules, token_counts, token_shards, toxicity
from .labelled import held_out
from .words import WORD


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = exact_dedup.exact_groups(_table(spark, sf_dir, "documents"))
    return groups.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("sha")).alias("text_sha256"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    held = held_out(F.col("doc_id"), 4, 2)
    scored = toxicity.toxicity(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"), held)
    return scored.select("doc_id", held.alias("held_out"), "score", "predicted")


def op3_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    added = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    conversations = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(added)
    return chat_format.digests(chat_format.format_conversations(conversations))


def op4_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.near_groups(_table(spark, sf_dir, "documents"), words=4, percent=85).select("doc_id", "n_shingles", "component_id")


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(mixing.document_sizes(_table(spark, sf_dir, "documents"))).select("doc_id", "size", "source_size", "target", "taken")


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return quality_rules.judged(docs, keep_text=False).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op7_token_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_shards.round_trip(_table(spark, sf_dir, "documents"))


def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    held = held_out(F.col("doc_id"), 3, 1)
    scored = quality_classifier.quality(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"), held)
    return scored.select("doc_id", held.alias("held_out"), "score", "predicted")


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(_table(spark, sf_dir, "documents"))


def op10_sentencepiece_nbest(spark: SparkSession, sf_dir: str) -> DataFrame:
    # best_ids is the first of nbest_ids
    return nbest_pieces.segmentations(_table(spark, sf_dir, "documents")).drop("best_ids")


def _with_planted_periods(docs: DataFrame) -> DataFrame:
    """doc_id, text; where a tenth of the ids' checksums says so, words from a place on are taken from one period. Rows without id stay as they are."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(WORD), F.lit(0))
    g, n = F.floor(h / 10), F.size("words")
    a = F.pmod(g, n)
    planted = docs.select("doc_id", "text", h.alias("h"), F.when(h % 10 == 0, words).alias("words"))
    planted = planted.withColumn("a", F.when(n > 0, a).cast("int")).withColumn("p", (1 + F.floor((n - F.col("a")) / (3 + g % 8))).cast("int"))
    from_period = lambda w, i: F.when(i < F.col("a"), w).otherwise(F.get("words", F.col("a") + (i - F.col("a")) % F.col("p")))
    text = F.when(F.col("p").isNotNull(), F.array_join(F.transform("words", from_period), " ")).otherwise(F.col("text"))
    return planted.select("doc_id", text.alias("text"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs.periodic_runs(_with_planted_periods(_table(spark, sf_dir, "documents")))
    line = lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])
    listed = F.array_join(F.transform("runs", lambda r: F.concat(line(r), F.lit("\n"))), "")
    best = F.col("strongest")
    milli = F.floor(1000 * best["length"] / best["period"]).cast("long")
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), best["start"].alias("start"), best["length"].alias("length"), best["period"].alias("period"),
        F.when(best.isNotNull(), milli).alias("exponent_milli"), F.sha2(listed.cast("binary"), 256).alias("runs_sha256"), F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


def op12_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    held = held_out(F.col("doc_id"), 10, 0)
    scored = katz.katz_scores(_table(spark, sf_dir, "documents"), ~held)
    return scored.select("doc_id", held.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _table(spark, sf_dir, "embeddings").select("vec_id", "embedding", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")).alias("label"))
    return hard_negatives.hard_negatives(vectors, F.col("id") % 100 == 0)


QUERIES = {f.__name__: f for name, f in list(globals().items()) if name.startswith("op")}

_WORDS = r"regexp_extract_all({0}, '[^\x20\x09-\x0D]+')"
_CONTROLS = ("<<SYS>>", "<</SYS>>", "[INST]", "[/INST]", "[ANS]", "[/ANS]", "[ROLE]", "[AS]", "[/ROLE]", "<s>", "</s>")
_ESCAPED = "length(t) + length(t) - length(replace(t, '\\', ''))" + "".join(f" + 2 * (length(t) - length(replace(t, '{c}', ''))) // {len(c)}" for c in _CONTROLS)

ORACLE_SQL: dict[str, str] = {
    "op1_exact_dedup": """
        SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
               doc_id = max(doc_id) OVER w AS kept, sha256(coalesce(text, '')) AS text_sha256
        FROM documents WINDOW w AS (PARTITION BY coalesce(text, ''))
    """,
    # marks: user 6 + 7, assistant 5 + 6, system 7 + 8; begin and end 3 + 4
    "op3_chat_format": f"""
        WITH said AS (
            SELECT conv_id, turn, role, coalesce(text, '') AS t FROM conversations
            UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')
        ), sized AS (
            SELECT *, {_ESCAPED} + CASE role WHEN 'user' THEN 13 WHEN 'assistant' THEN 11 WHEN 'system' THEN 15 END AS chars,
                   lag(role) OVER (PARTITION BY conv_id ORDER BY turn) AS before,
                   row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) = 1 AS last
            FROM said
        )
        SELECT conv_id, count(*) AS n_turns,
               sha256(string_agg(role || chr(10) || t || chr(10), '' ORDER BY turn)) AS turns_sha256,
               CAST(sum(CASE WHEN role = 'assistant' THEN length(t) ELSE 0 END) AS BIGINT) AS loss_chars,
               sha256(coalesce(string_agg(t, '' ORDER BY turn) FILTER (role = 'assistant'), '')) AS loss_sha256,
               CAST(sum(chars) + 7 AS BIGINT) AS formatted_chars,
               bool_and(CASE role WHEN 'system' THEN before IS NULL WHEN 'user' THEN coalesce(before, 'system') IN ('system', 'assistant')
                                  ELSE coalesce(before, '') = 'user' END AND (NOT last OR role = 'assistant')) AS valid
        FROM sized GROUP BY conv_id
    """,
    "op4_ngram_jaccard_join": rf"""
        WITH RECURSIVE words AS (
            SELECT doc_id, {_WORDS.format("translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} AS w FROM documents
        ), sets AS (
            SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
                   ELSE list_distinct(list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' '))) END AS s FROM words
        ), items AS (SELECT doc_id, len(s) AS n, unnest(s) AS x FROM sets),
        pairs AS (
            SELECT a.doc_id AS a, b.doc_id AS b FROM items a JOIN items b ON a.x = b.x AND a.doc_id < b.doc_id
            GROUP BY a.doc_id, b.doc_id HAVING 100 * count(*) >= 85 * (min(a.n) + min(b.n) - count(*))
        ), links AS (SELECT a, b FROM pairs UNION ALL SELECT b, a FROM pairs),
        reach AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a)
        SELECT s.doc_id, CAST(len(s) AS BIGINT) AS n_shingles, m.component_id
        FROM sets s JOIN (SELECT a, min(b) AS component_id FROM reach GROUP BY a) m ON s.doc_id = m.a
    """,
    "op5_mixing": rf"""
        WITH sized AS (SELECT doc_id, source, CAST(coalesce(len({_WORDS.format("text")}), 0) AS BIGINT) AS size FROM documents),
        sources AS (
            SELECT source, CAST(sum(size) AS BIGINT) AS source_size, [1.0::DOUBLE, 2.0::DOUBLE, 3.0::DOUBLE][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS weight,
                   row_number() OVER (ORDER BY source NULLS LAST) AS nr
            FROM sized GROUP BY source
        ), rates AS (
            SELECT *, source_size * 3.0::DOUBLE AS most,
                   (sum(source_size) OVER () - coalesce(sum(source_size * 3.0::DOUBLE) OVER w, 0)) / (sum(weight) OVER () - coalesce(sum(weight) OVER w, 0)) AS rate
            FROM sources WINDOW w AS (ORDER BY source_size * 3.0::DOUBLE / weight, nr ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
        ), open AS (SELECT rate FROM rates WHERE most > rate * weight ORDER BY most / weight, nr LIMIT 1),
        targets AS (
            SELECT source, source_size, CASE WHEN most <= rates.rate * weight THEN most ELSE (SELECT rate FROM open) * weight END AS target FROM rates
        ), placed AS (
            SELECT d.doc_id, d.size, t.source_size, t.target, CAST(floor(t.target) AS BIGINT) AS budget,
                   coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY md5(CAST(d.doc_id AS VARCHAR)), d.doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
            FROM sized d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source
        )
        SELECT doc_id, size, source_size, target,
               CAST(CASE WHEN source_size = 0 THEN 0 ELSE (budget // source_size) * size + greatest(0, least(size, budget % source_size - start)) END AS BIGINT) AS taken
        FROM placed
    """,
    "op6_quality_rules": rf"""
        WITH split AS (SELECT doc_id, source, coalesce(text, '') AS t, {_WORDS.format("coalesce(text, '')")} AS w FROM documents),
        spots AS (SELECT doc_id, i, array_to_string(w[i:i + 4], ' ') AS x FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM split WHERE len(w) >= 5)),
        twice AS (SELECT doc_id, i FROM spots QUALIFY count(*) OVER (PARTITION BY doc_id, x) > 1),
        repeats AS (SELECT doc_id, count(DISTINCT j) AS n FROM (SELECT doc_id, unnest(range(i, i + 5)) AS j FROM twice) GROUP BY doc_id),
        lines AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM split) WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id),
        base AS (
            SELECT s.doc_id, s.source, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
                   CAST(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols, CAST(coalesce(l.n, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(r.n, 0) AS BIGINT) AS n_repeat_words
            FROM split s LEFT JOIN repeats r USING (doc_id) LEFT JOIN lines l USING (doc_id)
        ), failed AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM base),
        hosts AS (SELECT source, count(*) AS n, count(*) FILTER (base_failed) AS f FROM failed GROUP BY source),
        prior AS (SELECT sum(f) / sum(n) AS m, var_pop(f / n) AS v, max(n) AS most FROM hosts),
        verdicts AS (SELECT source, (f + m * s) / (n + s) <= 0.5 AS host_kept FROM hosts, (SELECT m, CASE WHEN v > 0 THEN greatest(1, m * (1 - m) / v - 1) ELSE most END AS s FROM prior))
        SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND host_kept AS kept
        FROM failed JOIN verdicts ON failed.source IS NOT DISTINCT FROM verdicts.source
    """,
    "op13_hard_negatives": """
        WITH v AS (
            SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS c
            FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), s AS (
            SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, CAST(list_dot_product(a.c, b.c) AS BIGINT) AS score
            FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id
        ), p AS (SELECT * FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
        SELECT p.anchor_id, p.vec_id AS positive_id, CAST(row_number() OVER (PARTITION BY p.anchor_id, p.vec_id ORDER BY n.score DESC, n.vec_id) AS INTEGER) AS rank,
               n.vec_id AS negative_id, p.score AS positive_score, n.score AS negative_score
        FROM p JOIN s n ON n.anchor_id = p.anchor_id AND NOT n.same AND 30 * p.score <= 100 * n.score AND 100 * n.score <= 90 * p.score
        QUALIFY rank <= 10
    """,
}
