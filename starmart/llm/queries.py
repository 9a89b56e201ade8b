"""One query for each operator over the driver tables, and its SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart.llm import (
    decontaminate,
    hash_ring,
    jaccard_join,
    kneser_ney,
    license_scan,
    packing,
    prefix_trie,
    quality_rules,
    simhash,
    suffix_dedup,
    url_cascade,
    warc,
    whitening,
)


def _table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


#: Rules by host and path; the longest that fits a url decides.
URL_RULES = {"net/": "block", "example.net/en/": "allow", "example.com/de/": "block", "org/fr/": "allow"}
#: Pages of less html than this put their key on the list: there is hardly a text in them.
THIN_PAGE_BYTES = 1500


def op1_url_filters(spark: SparkSession, sf: str) -> DataFrame:
    pages = _table(spark, sf, "pages")
    thin = F.coalesce(F.octet_length("html"), F.lit(0)) < THIN_PAGE_BYTES
    return url_cascade.judge(pages, thin, URL_RULES)


def op2_quality_rules(spark: SparkSession, sf: str) -> DataFrame:
    return quality_rules.judge(_table(spark, sf, "documents"))


def op3_sharding(spark: SparkSession, sf: str) -> DataFrame:
    dealt = hash_ring.assign(_table(spark, sf, "documents"))
    return dealt.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def op4_license_scans(spark: SparkSession, sf: str) -> DataFrame:
    return license_scan.scan(_table(spark, sf, "documents"))


def op5_decontamination(spark: SparkSession, sf: str) -> DataFrame:
    found = decontaminate.report(_table(spark, sf, "documents"), _table(spark, sf, "benchmark"))
    digest = F.sha2(F.array_join("items", ",").cast("binary"), 256)
    return found.select("doc_id", "n_words", "n_hit", "n_items", digest.alias("items_sha256"), "contaminated")


def op6_jaccard_join(spark: SparkSession, sf: str) -> DataFrame:
    return jaccard_join.join(_table(spark, sf, "documents"))


def op7_warc(spark: SparkSession, sf: str) -> DataFrame:
    return warc.round_trip(_table(spark, sf, "pages"))


def op8_quality_classifier(spark: SparkSession, sf: str) -> DataFrame:
    trusted = _table(spark, sf, "labels").where("quality = 1 AND toxic = 0").select("doc_id")
    return kneser_ney.classify(_table(spark, sf, "documents"), trusted)


def op9_packing(spark: SparkSession, sf: str) -> DataFrame:
    return packing.pack(_table(spark, sf, "documents"))


def op10_suffix_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return suffix_dedup.digest(_table(spark, sf, "documents"))


def op11_embedding_whitening(spark: SparkSession, sf: str) -> DataFrame:
    out = whitening.whiten(_table(spark, sf, "embeddings"), components=16)
    return out.withColumn("deviation", F.expr("try_cast(deviation AS long)"))


def op12_prefix_trie(spark: SparkSession, sf: str) -> DataFrame:
    return prefix_trie.report(_table(spark, sf, "conversations"))


def op13_simhash(spark: SparkSession, sf: str) -> DataFrame:
    return simhash.near_duplicates(_table(spark, sf, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_url_filters": op1_url_filters,
    "op2_quality_rules": op2_quality_rules,
    "op3_sharding": op3_sharding,
    "op4_license_scans": op4_license_scans,
    "op5_decontamination": op5_decontamination,
    "op6_jaccard_join": op6_jaccard_join,
    "op7_warc": op7_warc,
    "op8_quality_classifier": op8_quality_classifier,
    "op9_packing": op9_packing,
    "op10_suffix_dedup": op10_suffix_dedup,
    "op11_embedding_whitening": op11_embedding_whitening,
    "op12_prefix_trie": op12_prefix_trie,
    "op13_simhash": op13_simhash,
}

ORACLES: dict[str, str] = {
    "op1_url_filters": r"""
WITH p AS (
    SELECT page_id, coalesce(strlen(html), 0) < 1500 AS thin,
           translate(coalesce(regexp_extract(url, '://([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
           coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') AS path
    FROM pages
),
l AS (SELECT *, coalesce(bool_or(thin) OVER (PARTITION BY host, path) AND host <> '', false) AS listed FROM p),
r AS (
    SELECT *, CASE
        WHEN (host = 'example.com' OR host LIKE '%.example.com') AND starts_with(path, '/de/') THEN 'example.com/de/'
        WHEN (host = 'example.net' OR host LIKE '%.example.net') AND starts_with(path, '/en/') THEN 'example.net/en/'
        WHEN (host = 'org' OR host LIKE '%.org') AND starts_with(path, '/fr/') THEN 'org/fr/'
        WHEN (host = 'net' OR host LIKE '%.net') AND starts_with(path, '/') THEN 'net/' END AS rule
    FROM l
)
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' WHEN rule IS NOT NULL THEN 'allow'
            WHEN listed THEN 'block' ELSE 'allow' END AS verdict, listed
FROM r
""",
    "op7_warc": r"""
WITH p AS (SELECT page_id, coalesce(html, '') AS b FROM pages),
h AS (SELECT page_id, strlen(b) AS n, sha256(b) AS d FROM p),
f AS (SELECT *, CASE WHEN n >= 100 THEN min(page_id) OVER (PARTITION BY d) END AS first FROM h)
SELECT page_id, n::BIGINT AS payload_bytes, d AS payload_digest,
       CASE WHEN first IS NULL OR page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to
FROM f
""",
    "op2_quality_rules": r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT r, doc_id, t, list_filter(regexp_split_to_array(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM d),
p AS (SELECT r, w, unnest(range(1, len(w) - 1)) AS i FROM w),
g AS (SELECT r, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g FROM p),
twice AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS n FROM g) WHERE n > 1),
covered AS (SELECT r, count(DISTINCT i + o) AS n FROM twice, (VALUES (0), (1), (2)) AS o(o) GROUP BY r),
lines AS (SELECT r, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM d),
m AS (
    SELECT doc_id, t, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
           (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
           (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g')))::BIGINT AS n_capitals,
           len(l)::BIGINT AS n_lines, (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines,
           coalesce(n, 0)::BIGINT AS n_repeat_words
    FROM w JOIN lines USING (r) LEFT JOIN covered USING (r)
),
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT (base_failed OR n_symbols * 10 > n_words * 3 OR n_capitals * 2 > word_chars OR n_dup_lines * 2 > n_lines
            OR word_chars < n_words * 2 OR word_chars > n_words * 20) AS kept
FROM b
""",
    "op5_decontamination": r"""
WITH d AS (
    SELECT row_number() OVER () AS r, doc_id,
           list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                       '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w
    FROM documents
),
b AS (
    SELECT item_id,
           list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                       '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w
    FROM benchmark
),
bg AS (
    SELECT DISTINCT item_id, k, array_to_string(w[i:i + k - 1], ' ') AS g
    FROM (SELECT item_id, w, least(len(w), 13) AS k, unnest(range(1, len(w) - least(len(w), 13) + 2)) AS i FROM b WHERE len(w) > 0)
),
lens AS (SELECT DISTINCT k FROM bg),
dg AS (
    SELECT r, k, i, array_to_string(w[i:i + k - 1], ' ') AS g
    FROM (SELECT r, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM d, lens WHERE len(w) >= k)
),
hit AS (SELECT DISTINCT dg.r, dg.i, dg.k, bg.item_id FROM dg JOIN bg USING (k, g)),
nh AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + k)) AS p FROM (SELECT DISTINCT r, i, k FROM hit)) GROUP BY r),
ni AS (SELECT r, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS items FROM hit GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN nh USING (r) LEFT JOIN ni USING (r)
""",
}
