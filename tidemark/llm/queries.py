"""The registered queries of the training-data operators: each applies its
operator to a whole table. ``ORACLE_SQL`` holds DuckDB SQL where SQL can
express the result; the others are tested against brute force."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (
    chat_trees,
    four_russians,
    mix_sources,
    nra_topk,
    overlap_search,
    quality_gbt,
    secret_battery,
    simhash_tiles,
    suffix_buckets,
    token_counts,
    token_spans,
    url_filter,
    word_table_bpe,
)
from tidemark.llm.common import table

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLE_SQL: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE_SQL[name] = sql
        return fn

    return deco


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


# --- 1: quality rules -------------------------------------------------------


@register("op1_quality_rules")
def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_gbt.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


# --- 2: exact top-k search --------------------------------------------------


@register("op2_topk_search", r"""
WITH whole AS (
  SELECT vec_id, min(list_transform(embedding, lambda x: CAST(floor(1024.0::DOUBLE * CAST(x AS DOUBLE)) AS BIGINT))) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
  GROUP BY vec_id
),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id,
    CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p: coalesce(p[1] * p[2], 0))) AS BIGINT) AS score
  FROM whole q JOIN whole c ON q.vec_id <> c.vec_id
  WHERE q.vec_id % 100 = 0
),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS place FROM scored
)
SELECT query_id, CAST(place AS INTEGER) AS rank, vec_id, score FROM ranked WHERE place <= 10""")
def op2_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nra_topk.top_k(table(spark, sf_dir, "embeddings"), F.col("id") % 100 == 0)


# --- 3: SimHash near-duplicates ---------------------------------------------


@register("op3_simhash_dedup")
def op3_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_tiles.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, radius=2)


# --- 4: token counts --------------------------------------------------------


@register("op4_token_counts")
def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"), limit=512)


# --- 5: repeated strings ----------------------------------------------------


@register("op5_suffix_dedup")
def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = suffix_buckets.remove_repeats(table(spark, sf_dir, "documents"), length=200)
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda a, x: a + x["end"] - x["start"])
    return cut.select(
        "doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256")
    )


# --- 6: mixing sources ------------------------------------------------------

# {docs}: the table or CTE to mix
MIX_CTES = r"""
mix_docs AS (
  SELECT *,
    CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
    CASE WHEN length(text) > 0 THEN
      CAST(length(translate(text, '#*$%&|<>', '')) AS DOUBLE) / CAST(length(text) AS DOUBLE) END AS share,
    -ln((CAST(CAST('0x' || substr(md5(CAST(doc_id AS VARCHAR)), 1, 13) AS BIGINT) AS DOUBLE) + 0.5)
        / 4503599627370496.0::DOUBLE) AS draw
  FROM {docs}
),
mix_per AS (
  SELECT source, sum(size)::BIGINT AS source_size,
    CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END::BIGINT AS w
  FROM mix_docs GROUP BY source
),
mix_levels AS (
  SELECT *,
    150 * sum(source_size) OVER ()
      - 200 * coalesce(sum(source_size) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS left_over,
    sum(w) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS w_left
  FROM mix_per
  WINDOW o AS (ORDER BY CAST(source_size AS DOUBLE) / CAST(w AS DOUBLE), source NULLS LAST)
),
mix_capped AS (SELECT *, left_over * w >= 200 * source_size * w_left AS capped FROM mix_levels),
mix_level AS (
  SELECT left_over AS l, w_left AS wl FROM mix_capped WHERE NOT capped
  ORDER BY CAST(source_size AS DOUBLE) / CAST(w AS DOUBLE), source NULLS LAST LIMIT 1
),
mix_targets AS (
  SELECT *, floor(CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END)::BIGINT AS epochs FROM (
    SELECT source, source_size,
      CASE WHEN capped THEN CAST(2 * source_size AS DOUBLE)
           ELSE (SELECT CAST(mix_capped.w * l AS DOUBLE) / CAST(100 * wl AS DOUBLE) FROM mix_level) END AS target
    FROM mix_capped)
),
mix_sums AS (
  SELECT d.*, t.source_size, t.target, t.epochs, t.target - CAST(t.epochs * t.source_size AS DOUBLE) AS rest,
    coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY
        CASE WHEN share * share > 0 THEN draw / (share * share) END NULLS LAST, draw, doc_id NULLS LAST
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS done
  FROM mix_docs d JOIN mix_targets t ON d.source IS NOT DISTINCT FROM t.source
),
mixed AS (
  SELECT *, epochs + CASE WHEN rest > 0 AND 2 * done + size <= 2 * rest THEN 1 ELSE 0 END AS copies FROM mix_sums
)"""


@register("op6_mix_sources", "WITH " + MIX_CTES.replace("{docs}", "documents") + """
SELECT doc_id, size, source_size, target, CAST(size * copies AS BIGINT) AS taken, CAST(copies AS BIGINT) AS copies FROM mixed""")
def op6_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources.mix(table(spark, sf_dir, "documents"))


# --- 7: chat formatting -----------------------------------------------------


@register("op7_chat_format")
def op7_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    told = "</s>[INST] ok [/INST]"
    more = spark.createDataFrame([(-7, 0, "user", told), (-7, 1, "assistant", told)], rows.schema)
    nodes = chat_trees.linear(rows.unionByName(more))
    return chat_trees.digests(chat_trees.format_trees(nodes, top=1))


# --- 8: BPE encoding and decoding -------------------------------------------


def bpe_digests(docs: DataFrame) -> DataFrame:
    """Digests of ids and decoded texts; the tasks that encode also decode."""
    path = tokenizer_path("word_bpe_49k.json")
    coded = word_table_bpe.encode(docs, path, then=word_table_bpe.decoder(docs.sparkSession, path))
    return coded.select(
        "doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


@register("op8_bpe_codec")
def op8_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_digests(table(spark, sf_dir, "documents"))


# --- 9: URL filter ----------------------------------------------------------

URL_RULES = [
    url_filter.Rule("allow", "com", "/"),
    url_filter.Rule("block", "example.com", "/en/"),
    url_filter.Rule("allow", "www.example.com", "/en/"),
    url_filter.Rule("block", "net", "/es/"),
    url_filter.Rule("block", "net", "/fr/"),
]
# hosts whose pages are listed: the list is drawn from the pages themselves
LISTED_HOSTS = r"^([a-z0-9]+\.)?(cheap-pills|adult-x|casino-win|free-bets|ads-track|spam-farm)\."


@register("op9_url_filter", r"""
WITH parts AS (
  SELECT page_id, url, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) END AS rest FROM pages
),
hosts AS (
  SELECT page_id, url,
    coalesce(translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
    coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path,
    regexp_replace(regexp_replace(regexp_extract(url, '^[^?#]*\?([^#]*)', 1), '(^|&)utm_[^&]*', '', 'g'), '^&+', '') AS query
  FROM parts
),
canon AS (
  SELECT *, CASE WHEN instr(url, '://') > 0 THEN
      regexp_replace(host, '^(www|m)\.', '') || regexp_replace(path, '(/index\.html|/)+$', '')
      || CASE WHEN query = '' THEN '' ELSE '?' || query END END AS canon
  FROM hosts
),
listed AS (
  SELECT DISTINCT canon FROM canon
  WHERE canon IS NOT NULL
    AND regexp_matches(host, '^([a-z0-9]+\.)?(cheap-pills|adult-x|casino-win|free-bets|ads-track|spam-farm)\.')
),
ruled AS (
  SELECT c.*, l.canon IS NOT NULL AS in_list,
    CASE WHEN (host = 'www.example.com' OR host LIKE '%.www.example.com') AND path LIKE '/en/%' THEN 'www.example.com/en/'
         WHEN (host = 'example.com' OR host LIKE '%.example.com') AND path LIKE '/en/%' THEN 'example.com/en/'
         WHEN (host = 'net' OR host LIKE '%.net') AND path LIKE '/fr/%' THEN 'net/fr/'
         WHEN (host = 'net' OR host LIKE '%.net') AND path LIKE '/es/%' THEN 'net/es/'
         WHEN (host = 'com' OR host LIKE '%.com') AND path LIKE '/%' THEN 'com/' END AS rule
  FROM canon c LEFT JOIN listed l ON c.canon = l.canon
)
SELECT page_id, host, path, rule,
  CASE WHEN rule IN ('www.example.com/en/', 'com/') THEN 'allow'
       WHEN rule IS NOT NULL THEN 'block'
       WHEN in_list THEN 'block' ELSE 'allow' END AS verdict,
  rule IS NULL AND in_list AS listed
FROM ruled""")
def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    listed = pages.where(url_filter.host_of(F.col("url")).rlike(LISTED_HOSTS)).select("url")
    return url_filter.judge_urls(pages, listed, URL_RULES)


# --- 10: secret scan --------------------------------------------------------


@register("op10_secret_scan")
def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_battery.scan(table(spark, sf_dir, "documents"))


# --- 11: hard negatives -----------------------------------------------------


@register("op11_hard_negatives", r"""
WITH whole AS (
  SELECT row_number() OVER () AS rn, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: CAST(floor(256.0::DOUBLE * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
scored AS (
  SELECT a.rn AS anchor, a.vec_id AS anchor_id, c.rn AS other, c.vec_id AS other_id, a.label = c.label AS same,
    CAST(coalesce(list_sum(list_transform(list_zip(a.v, c.v), lambda p: coalesce(p[1] * p[2], 0))), 0) AS BIGINT) AS score
  FROM whole a JOIN whole c ON a.rn <> c.rn
  WHERE a.vec_id % 50 = 0
),
positives AS (
  SELECT *, row_number() OVER (PARTITION BY anchor ORDER BY score DESC, other_id NULLS LAST, other) AS place
  FROM scored WHERE same QUALIFY place <= 5
),
negatives AS (
  SELECT p.anchor_id, p.other_id AS positive_id, n.other_id AS negative_id, p.score AS positive_score, n.score AS negative_score,
    row_number() OVER (PARTITION BY p.anchor, p.place ORDER BY n.score DESC, n.other_id NULLS LAST) AS place
  FROM positives p JOIN scored n
    ON p.anchor = n.anchor AND NOT n.same AND 50 * p.score <= 100 * n.score AND 100 * n.score <= 95 * p.score
)
SELECT anchor_id, positive_id, CAST(place AS INTEGER) AS rank, negative_id, positive_score, negative_score
FROM negatives WHERE place <= 3""")
def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return four_russians.hard_negatives(rows.withColumn("label", moved), F.col("id") % 50 == 0)


# --- 12: n-gram Jaccard join --------------------------------------------------


@register("op12_jaccard_join")
def op12_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return overlap_search.overlap_classes(table(spark, sf_dir, "documents"), shingle=5, percent=80)


# --- 13: tokenizer alignment --------------------------------------------------


def span_digests(docs: DataFrame, *, most: int = token_spans.BROADCAST_PAIRS) -> DataFrame:
    paths = tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model")
    aligned = token_spans.align(docs, *paths)
    told = aligned.withColumn("groups_sha256", F.coalesce(F.sha2("groups", 256), F.lit(""))).drop("groups")
    return token_spans.link_counts(told, *paths, most=most).select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


@register("op13_token_spans")
def op13_token_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return span_digests(table(spark, sf_dir, "documents"))
