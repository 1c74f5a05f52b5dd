"""Registered queries of this package, over whole tables and with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.llm import (
    arrow_ids,
    bottom_k,
    conversation_repair,
    filter_audit,
    hilbert,
    host_rules,
    imatch,
    learned_index,
    mixing,
    packing,
    secret_scan,
    toxicity,
    warc,
)


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_packing(spark: SparkSession, folder: str) -> DataFrame:
    """Pieces of all documents in sequences of at most 2048 tokens."""
    pieces = packing.pack_documents(
        _table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"), end_id=1
    )
    return pieces.select(
        "doc_id",
        "start",
        "length",
        F.crc32("ids").alias("ids_crc32"),
        "doc_tokens",
        "sequence_id",
        "offset",
        "sequence_tokens",
        "tier",
        "step_group",
    )


def op2_learned_index(spark: SparkSession, folder: str) -> DataFrame:
    """The 10 nearest vectors found for every hundredth vector, among all rows."""
    table = _table(spark, folder, "embeddings")
    return learned_index.nearest_rows(table, table.where("vec_id % 100 = 0"), k=10)


def op3_warc(spark: SparkSession, folder: str) -> DataFrame:
    """Payload, kind and reference of every page as read back from its archive."""
    found = warc.page_captures(_table(spark, folder, "pages"), payloads=False)

    def noted(name: str):
        own = F.filter(F.try_element_at("metadata", F.lit(1))["fields"], lambda f: f["key"] == name)
        return F.try_element_at(own, F.lit(1))["value"].cast("long")

    return found.select(
        noted("page-id").alias("page_id"),
        F.col("response.payload_bytes").alias("payload_bytes"),
        F.col("response.payload_digest").alias("payload_digest"),
        F.col("response.kind").alias("record_type"),
        noted("refers-to-page").alias("refers_to"),
    )


def op4_source_mix(spark: SparkSession, folder: str) -> DataFrame:
    """Words that the mix takes of every document, and the target of its source."""
    return mixing.mixed_documents(_table(spark, folder, "documents"))


def op5_imatch(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprints of every document and its edited text, and their likeness."""
    docs = _table(spark, folder, "documents")
    return imatch.fingerprint_documents(docs, imatch.lexicon(docs))


def op6_secrets(spark: SparkSession, folder: str) -> DataFrame:
    """Findings of the rules and of the network in every document."""
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    found = secret_scan.find_secrets(docs, secret_scan.train_on_documents(docs))

    def joined(rows):
        return F.array_join(
            F.transform(
                rows,
                lambda s: F.concat_ws(
                    ":",
                    F.element_at(F.lit(list(secret_scan.KINDS)), s["kind"] + 1),
                    s["start"].cast("string"),
                    s["end"].cast("string"),
                ),
            ),
            ",",
        )

    def number(kind: int):
        return F.size(F.filter("secrets", lambda s: s["kind"] == kind)).cast("long")

    base = F.filter("secrets", lambda s: s["kind"] < 3)
    return found.select(
        "doc_id",
        number(0).alias("n_assign"),
        number(1).alias("n_access"),
        number(2).alias("n_hex"),
        F.sha2(joined(base), 256).alias("base_sha256"),
        joined(F.col("secrets")).alias("spans"),
        number(3).alias("n_network"),
    )


def op7_hilbert_shards(spark: SparkSession, folder: str) -> DataFrame:
    """Shard and slot of every document along the Hilbert curve, in 40 equal counts."""
    placed = hilbert.hilbert_shards(_table(spark, folder, "documents"), shards=40)
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
        "curve_index",
    )


def op8_bottom_k(spark: SparkSession, folder: str) -> DataFrame:
    """Near-duplicate group of every document."""
    return bottom_k.near_duplicates(_table(spark, folder, "documents"))


def op9_arrow_ids(spark: SparkSession, folder: str) -> DataFrame:
    """Place, number and checksum of every document's ids, read back from Arrow files."""
    docs = _table(spark, folder, "documents")
    path = public_tokenizers.path("word_bpe_49k.json")
    return arrow_ids.ids_round_trip(docs, path, end_id=2).drop("part")


def op10_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """Expected severity, grade and verdict for every document."""
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    model = toxicity.train_severity(docs, _table(spark, folder, "labels"))
    return toxicity.score_severity(docs, model).select("doc_id", "severity", "grade", "toxic")


def op11_conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    """Faults, cheapest edits and repaired text's digest of every damaged conversation."""
    turns = _table(spark, folder, "conversations")
    return conversation_repair.repair_reports(turns, conversation_repair.damage(turns))


def op12_filter_audit(spark: SparkSession, folder: str) -> DataFrame:
    """What each of five filters removes in every order, by language."""
    return filter_audit.audit_filters(_table(spark, folder, "documents"), _table(spark, folder, "labels"))


def op13_host_rules(spark: SparkSession, folder: str) -> DataFrame:
    """Measures of every document, and the verdict of rules on it and on its source."""
    rows = host_rules.judged(_table(spark, folder, "documents"), F.col("source"))
    return rows.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
        "host_rejected",
    )


QUERIES = {
    "op1_packing": op1_packing,
    "op2_learned_index": op2_learned_index,
    "op3_warc": op3_warc,
    "op4_source_mix": op4_source_mix,
    "op5_imatch": op5_imatch,
    "op6_secrets": op6_secrets,
    "op7_hilbert_shards": op7_hilbert_shards,
    "op8_bottom_k": op8_bottom_k,
    "op9_arrow_ids": op9_arrow_ids,
    "op10_toxicity": op10_toxicity,
    "op11_conversation_repair": op11_conversation_repair,
    "op12_filter_audit": op12_filter_audit,
    "op13_host_rules": op13_host_rules,
}
ORACLE: dict[str, str] = {
    "op3_warc": """
WITH payloads AS (
    SELECT page_id, coalesce(html, '') AS payload FROM pages
), hashed AS (
    SELECT page_id, strlen(payload) AS payload_bytes, sha1(payload) AS hex,
           min(page_id) OVER (PARTITION BY payload) AS first_id
    FROM payloads
)
SELECT page_id, payload_bytes,
       list_aggregate(list_transform(range(8), lambda i:
           list_aggregate(list_transform([15, 10, 5, 0], lambda s:
               substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                      ((('0x' || substr(hex, 5 * i + 1, 5))::BIGINT >> s) & 31) + 1, 1)
           ), 'string_agg', '')), 'string_agg', '') AS payload_digest,
       CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = first_id THEN NULL ELSE first_id END AS refers_to
FROM hashed
""",
    "op12_filter_audit": r"""
WITH words AS (
    SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t,
           regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
    FROM documents
), fails AS (
    SELECT doc_id, part, list_filter(['A', 'B', 'C', 'D', 'E'], lambda f: CASE f
        WHEN 'A' THEN len(w) < 100
        WHEN 'B' THEN 100 * len(list_distinct(w)) < 80 * len(w)
        WHEN 'C' THEN 100 * len(regexp_extract_all(t, '[A-Z]')) > 10 * length(t)
        WHEN 'D' THEN regexp_matches(t, '[#$%&*|]')
        ELSE e END) AS failed
    FROM (SELECT *, doc_id > min(doc_id) OVER (PARTITION BY t) AS e FROM words)
), counts AS (
    SELECT part, failed, count(*) AS n,
           count(*) FILTER (WHERE quality = 1) AS good, count(*) FILTER (WHERE toxic = 1) AS toxic
    FROM fails LEFT JOIN labels USING (doc_id) GROUP BY part, failed
), letters AS (
    SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS l
), orders AS (
    SELECT [a.l, b.l, c.l, d.l, e.l] AS o FROM letters a, letters b, letters c, letters d, letters e
    WHERE len(list_distinct([a.l, b.l, c.l, d.l, e.l])) = 5
), steps AS (
    SELECT array_to_string(o, '') AS filter_order, s::INTEGER AS step, o[s] AS f, o[1:s - 1] AS before
    FROM orders, range(1, 6) r(s)
), audit AS (
    SELECT part, filter_order, step, f,
        coalesce(sum(n) FILTER (WHERE NOT list_contains(failed, f) AND NOT list_has_any(failed, before)), 0)::BIGINT AS kept,
        coalesce(sum(n) FILTER (WHERE list_contains(failed, f) AND NOT list_has_any(failed, before)), 0)::BIGINT AS removed,
        coalesce(sum(n) FILTER (WHERE list_contains(failed, f) AND list_has_any(failed, before)), 0)::BIGINT AS redundant,
        coalesce(sum(n) FILTER (WHERE failed = [f]), 0)::BIGINT AS unique_fails,
        coalesce(sum(good) FILTER (WHERE list_contains(failed, f) AND NOT list_has_any(failed, before)), 0)::BIGINT AS good_lost,
        coalesce(sum(toxic) FILTER (WHERE list_contains(failed, f) AND NOT list_has_any(failed, before)), 0)::BIGINT AS toxic_lost
    FROM counts, steps GROUP BY part, filter_order, step, f
)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       (sum(removed) OVER (PARTITION BY part, f))::BIGINT AS shapley
FROM audit
""",
    "op13_host_rules": r"""
WITH texts AS (
    SELECT doc_id, source, coalesce(text, '') AS t FROM documents
), listed AS (
    SELECT doc_id, source, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w,
           list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
    FROM texts
), words AS (
    SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM listed
), windows AS (
    SELECT doc_id, i, word || ' ' || lead(word, 1) OVER o || ' ' || lead(word, 2) OVER o || ' ' ||
           lead(word, 3) OVER o || ' ' || lead(word, 4) OVER o AS five
    FROM words WINDOW o AS (PARTITION BY doc_id ORDER BY i)
), often AS (
    SELECT doc_id, unnest(range(i, i + 5)) AS i FROM (
        SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, five) AS times FROM windows WHERE five IS NOT NULL
    ) WHERE times > 1
), repeats AS (
    SELECT doc_id, count(DISTINCT i) AS n FROM often GROUP BY doc_id
), measured AS (
    SELECT doc_id, source, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
           len(regexp_extract_all(t, '[#*$%&|<>]'))::BIGINT AS n_symbols, len(lines) AS n_lines,
           (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(n, 0)::BIGINT AS n_repeat_words
    FROM listed LEFT JOIN repeats USING (doc_id)
), ruled AS (
    SELECT doc_id, source, rule, CASE rule WHEN 'short' THEN n_words < 10
        WHEN 'repeated' THEN 100 * n_repeat_words > 20 * n_words
        WHEN 'symbols' THEN 100 * n_symbols > 10 * n_words
        ELSE 100 * n_dup_lines > 30 * n_lines END AS failed
    FROM measured, (SELECT unnest(['short', 'repeated', 'symbols', 'lines']) AS rule)
), hosts AS (
    SELECT rule, source, count(*)::DOUBLE AS n, (count(*) FILTER (WHERE failed))::DOUBLE AS f FROM ruled GROUP BY ALL
), sums AS (
    SELECT rule, count(*) AS h, sum(n) AS docs, sum(f) / sum(n) AS m, sum(n * n) AS squares,
           sum(f * f / n) - sum(f) * sum(f) / sum(n) AS spread
    FROM hosts GROUP BY rule
), priors AS (
    SELECT rule, m, spread - m * (1 - m) * (h - 1) AS between_hosts,
           m * (1 - m) * (docs - squares / docs - (h - 1)) AS room
    FROM sums
), rejected AS (
    SELECT source FROM hosts JOIN priors USING (rule) GROUP BY source
    HAVING bool_or(CASE WHEN between_hosts <= 0 OR room <= 0 THEN m
        ELSE (f + m * greatest(0, room / between_hosts - 1)) / (n + greatest(0, room / between_hosts - 1)) END > 0.5)
), verdicts AS (
    SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
           EXISTS (SELECT 1 FROM rejected r WHERE r.source IS NOT DISTINCT FROM measured.source) AS host_rejected
    FROM measured
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT host_rejected AS kept, host_rejected
FROM verdicts
""",
}
