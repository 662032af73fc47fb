"""The registered queries of this subpackage and the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import public_tokenizers

from parcelpulse.llm import bpe_codec, conversation_repair, embed_dedup, filter_audit, license_scan, minhash, mixing
from parcelpulse.llm import packing, pii, quality, token_counts, token_store, url_filter
from parcelpulse.llm.common import table
from parcelpulse.session import new_folder

#: The rules of the url query as (host, path, verdict).
URL_RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]

#: One vocabulary as the tokenizers library's file and as ranks.
BYTE_BPE = (public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken"))


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return url_filter.judge_urls(pages, rules).select("page_id", "host", "path", "rule", "verdict")


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = license_scan.scan_licenses(table(spark, sf_dir, "documents"))
    best = F.array_max(F.transform("matches", lambda m: F.struct(m.coverage, m.matched_words, m.license)))
    return found.select(
        "doc_id",
        F.size("matches").cast("long").alias("n_matches"),
        best.license.alias("license"),
        best.coverage.alias("coverage"),
        best.matched_words.alias("matched_words"),
        F.array_join(F.transform("matches", lambda m: F.concat_ws(":", m.license, m.start, m.stop)), ",").alias("spans"),
    )


def op3_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, folder = table(spark, sf_dir, "documents"), new_folder(spark, "token-store")
    shards = int(spark.conf.get("spark.sql.shuffle.partitions"))
    token_store.write_shards(docs, public_tokenizers.path("word_bpe_49k.json"), 2, folder, shards)
    return token_store.read_documents(spark, folder).select("doc_id", "start", "n_tokens", "ids_crc32")


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.spans_digest(pii.find(table(spark, sf_dir, "documents").select("doc_id", "text")))


def op5_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = bpe_codec.encode(table(spark, sf_dir, "documents"), BYTE_BPE[1], public_tokenizers.PATTERN)
    decoded = bpe_codec.decode(encoded, BYTE_BPE[1], public_tokenizers.PATTERN)
    return decoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = packing.pack(table(spark, sf_dir, "documents"), *BYTE_BPE, public_tokenizers.PATTERN)
    return packed.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


def op7_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


def op8_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embed_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), BYTE_BPE[0], public_tokenizers.PATTERN)


def op11_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"), [5.0, 2.0, 1.0])
    return mixed.select("doc_id", "size", "source_size", F.round("target", 6).alias("target"), "taken")


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit_filters(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = table(spark, sf_dir, "conversations")
    rows = conversation_repair.damaged(conversation_repair.clean_rows(conversations))
    return conversation_repair.audit_conversations(conversations, rows)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_url_filter": op1_url_filter,
    "op2_license_scan": op2_license_scan,
    "op3_token_store": op3_token_store,
    "op4_pii": op4_pii,
    "op5_bpe_codec": op5_bpe_codec,
    "op6_packing": op6_packing,
    "op7_minhash_dedup": op7_minhash_dedup,
    "op8_embedding_dedup": op8_embedding_dedup,
    "op9_quality_rules": op9_quality_rules,
    "op10_token_counts": op10_token_counts,
    "op11_mixing": op11_mixing,
    "op12_filter_audit": op12_filter_audit,
    "op13_conversation_repair": op13_conversation_repair,
}

ORACLE_SQL: dict[str, str] = {
    "op1_url_filter": """
        WITH parts AS (
            SELECT page_id,
                   CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest
            FROM pages),
        split AS (
            SELECT page_id,
                   translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                   regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
            FROM parts),
        rules(h, p, v) AS (VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'),
            ('www.example.com', '/en/', 'allow'), ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
        best AS (
            SELECT s.page_id, s.host, s.path, arg_max(h || p, length(h || p)) AS rule, arg_max(v, length(h || p)) AS verdict
            FROM split s LEFT JOIN rules
              ON (s.host = h OR ends_with(s.host, '.' || h)) AND starts_with(s.path, p)
            GROUP BY ALL)
        SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM best""",
    "op11_mixing": """
        WITH sized AS (
            SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size,
                   md5('42:' || coalesce(doc_id::VARCHAR, '') || ':' || coalesce(text, '')) AS digest
            FROM documents),
        sources AS (
            SELECT source, sum(size)::BIGINT AS source_size, sum(size)::DOUBLE * 3 AS cap,
                   [5.0, 2.0, 1.0][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1]::DOUBLE AS weight
            FROM sized GROUP BY source),
        -- the level of the water is the highest of those got by clamping the first sources by cap and weight
        cuts AS (
            SELECT sum(source_size) OVER () - coalesce(sum(cap) OVER before, 0) AS words,
                   sum(weight) OVER () - coalesce(sum(weight) OVER before, 0) AS weight
            FROM sources WINDOW before AS (ORDER BY cap / weight, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
        targets AS (
            SELECT source, source_size, least(cap, weight * (SELECT max(words / weight) FROM cuts)) AS target FROM sources),
        quotas AS (SELECT *, round(target)::BIGINT AS quota FROM targets),
        placed AS (
            SELECT doc_id, size, source_size, target, quota,
                   sum(size) OVER (PARTITION BY d.source ORDER BY digest, doc_id, size ROWS UNBOUNDED PRECEDING) AS upto
            FROM sized d JOIN quotas q ON d.source IS NOT DISTINCT FROM q.source)
        SELECT doc_id, size, source_size, round(target, 6) AS target,
               CASE WHEN source_size = 0 THEN 0
                    ELSE (quota // source_size) * size + greatest(0, least(quota % source_size - upto + size, size)) END::BIGINT AS taken
        FROM placed""",
    "op12_filter_audit": """
        WITH RECURSIVE labelled AS (
            SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
        texts AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text FROM documents),
        words AS (
            SELECT *, regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+') AS found, min(doc_id) OVER (PARTITION BY text) AS first FROM texts),
        failed AS (
            SELECT w.part, coalesce(l.good, false) AS good, coalesce(l.toxic, false) AS toxic,
                   CASE WHEN len(found) < 200 THEN 1 ELSE 0 END
                 + CASE WHEN 100 * len(list_distinct(found)) < 50 * len(found) THEN 2 ELSE 0 END
                 + CASE WHEN 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 2 * length(text) THEN 4 ELSE 0 END
                 + CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 8 ELSE 0 END
                 + CASE WHEN coalesce(first < w.doc_id, false) THEN 16 ELSE 0 END AS mask
            FROM words w LEFT JOIN labelled l ON w.doc_id = l.doc_id),
        masks AS (
            SELECT part, mask, count(*) AS n, count(*) FILTER (good) AS n_good, count(*) FILTER (toxic) AS n_toxic
            FROM failed GROUP BY part, mask),
        orders(filter_order, before) AS (
            SELECT '', 0
            UNION ALL
            SELECT filter_order || f, before + (1 << i)
            FROM orders, (VALUES ('A', 0), ('B', 1), ('C', 2), ('D', 3), ('E', 4)) AS letters(f, i)
            WHERE NOT contains(filter_order, f)),
        steps AS (
            SELECT o.filter_order, s.step, 1 << (ascii(substr(o.filter_order, s.step, 1)) - 65) AS own,
                   list_sum([1 << (ascii(x) - 65) FOR x IN string_split(substr(o.filter_order, 1, s.step - 1), '') IF x <> '']) AS earlier
            FROM orders o, (VALUES (1), (2), (3), (4), (5)) AS s(step) WHERE length(o.filter_order) = 5),
        counted AS (
            SELECT m.part, s.filter_order, s.step, s.own,
                   sum(CASE WHEN mask & (coalesce(earlier, 0) | own) = 0 THEN n ELSE 0 END)::BIGINT AS kept,
                   sum(CASE WHEN mask & coalesce(earlier, 0) = 0 AND mask & own <> 0 THEN n ELSE 0 END)::BIGINT AS removed,
                   sum(CASE WHEN mask & coalesce(earlier, 0) <> 0 AND mask & own <> 0 THEN n ELSE 0 END)::BIGINT AS redundant,
                   sum(CASE WHEN mask = own THEN n ELSE 0 END)::BIGINT AS unique_fails,
                   sum(CASE WHEN mask & coalesce(earlier, 0) = 0 AND mask & own <> 0 THEN n_good ELSE 0 END)::BIGINT AS good_lost,
                   sum(CASE WHEN mask & coalesce(earlier, 0) = 0 AND mask & own <> 0 THEN n_toxic ELSE 0 END)::BIGINT AS toxic_lost
            FROM masks m, steps s GROUP BY ALL)
        SELECT part, filter_order, step::INTEGER AS step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
               (sum(removed) OVER (PARTITION BY part, own))::BIGINT AS shapley
        FROM counted""",
}
