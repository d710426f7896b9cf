"""The queries of the operators over the given tables, and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (
    bpe,
    exact_dedup,
    grid_join,
    line_dedup,
    minhash,
    mixing,
    periodic_runs,
    prefix_counts,
    quality,
    rans,
    substring_dedup,
    url_filter,
    whitening,
)
from tidemark.llm.common import Scratch
from tidemark.llm.tokens import read_spec

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLE_SQL: dict[str, str] = {}


def _query(name: str, sql: str | None = None):
    def wrap(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE_SQL[name] = sql.strip()
        return fn

    return wrap


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


_LOWER = (
    "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
)

_MIX_SQL = r"""
WITH d AS (
  SELECT doc_id, source,
         CAST(len(list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'),
                              lambda x: x <> '')) AS BIGINT) AS size,
         CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15) AS BIGINT) AS h
  FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS rk FROM s),
c AS (SELECT *, CAST(rk % 3 + 1 AS BIGINT) AS weight, source_size * 3 AS cap FROM w),
l AS (
  SELECT *, CAST(cap AS DOUBLE) / weight AS ratio,
         sum(source_size) OVER () - (sum(cap) OVER (ORDER BY CAST(cap AS DOUBLE) / weight, rk
           ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - cap) AS rest_size,
         sum(weight) OVER (ORDER BY CAST(cap AS DOUBLE) / weight, rk
           ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rest_weight
  FROM c),
a AS (SELECT rest_size, rest_weight FROM l WHERE rest_size * weight <= cap * rest_weight
      ORDER BY ratio, rk LIMIT 1),
t AS (
  SELECT source, source_size,
         least(CAST(cap AS DOUBLE),
               CAST(a.rest_size AS DOUBLE) / CAST(a.rest_weight AS DOUBLE) * weight) AS target
  FROM l, a),
p AS (
  SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END
    AS fulls FROM t),
g AS (SELECT source, h, sum(size) AS size FROM d GROUP BY source, h),
r AS (SELECT source, h, size, sum(size) OVER (PARTITION BY source ORDER BY h) - size AS below FROM g)
SELECT d.doc_id, d.size, p.source_size, p.target,
       CAST(d.size * (p.fulls + CASE WHEN p.target > p.fulls * p.source_size
            AND r.below + r.size / 2.0 <= p.target - p.fulls * p.source_size
            THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM d JOIN p ON d.source IS NOT DISTINCT FROM p.source
       JOIN r ON d.source IS NOT DISTINCT FROM r.source AND d.h = r.h
"""


@_query("op2_mix_sources", _MIX_SQL)
def op2_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words each document gives to a mix of all sources weighing 1, 2, 3 in turn."""
    return mixing.mix_sources(_table(spark, sf_dir, "documents")).drop("copies")


_EXACT_SQL = f"""
WITH d AS (SELECT doc_id, sha256({_LOWER}) AS text_sha256 FROM documents)
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id = max(doc_id) OVER g AS kept, text_sha256
FROM d WINDOW g AS (PARTITION BY text_sha256)
"""


@_query("op3_exact_dedup", _EXACT_SQL)
def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which document of equal texts stays."""
    return exact_dedup.exact_dedup(_table(spark, sf_dir, "documents"))


# Fixed rules of the URL query: host, path, verdict.
URL_RULES = [
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
]

_URL_SQL = """
WITH r(rule_host, rule_path, rule_verdict) AS (VALUES
  ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'),
  ('com', '/fr/', 'allow'), ('com', '/de/', 'block')),
u AS (
  SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest
  FROM pages),
p AS (
  SELECT page_id,
         translate(regexp_extract(rest, '^([^/?#]*)', 1),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM u),
m AS (
  SELECT host, path, rule_host || rule_path AS rule, rule_verdict,
         row_number() OVER (PARTITION BY host, path
                            ORDER BY length(rule_host || rule_path) DESC) AS rk
  FROM (SELECT DISTINCT host, path FROM p) x JOIN r
    ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path))
SELECT p.page_id, p.host, p.path, m.rule, coalesce(m.rule_verdict, 'allow') AS verdict
FROM p LEFT JOIN m ON m.host = p.host AND m.path = p.path AND m.rk = 1
"""


@_query("op4_url_filter", _URL_SQL)
def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The verdict on every page's URL; URLs that no rule lists are allowed."""
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return url_filter.judge_urls(_table(spark, sf_dir, "pages"), rules)


@_query("op10_quality_classifier")
def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document; labels of held-out rows are not learnt."""
    docs = _table(spark, sf_dir, "documents")
    model = quality.fit(docs, _table(spark, sf_dir, "labels"))
    return quality.score_documents(docs, model)


WORD_BPE = public_tokenizers.path("word_bpe_49k.json")


@_query("op7_bpe")
def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every document's ids and of the text these decode to."""
    spec = read_spec(WORD_BPE)
    return bpe.digests(bpe.encode(_table(spark, sf_dir, "documents"), spec), spec)


BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
TOKEN_LIMIT = 512


@_query("op9_token_counts")
def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes and tokens of every document, and whether it is over the limit."""
    table = prefix_counts.prefix_table(_table(spark, sf_dir, "documents"), read_spec(BYTE_BPE))
    return table.select(
        "doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > TOKEN_LIMIT).alias("over_limit")
    )


@_query("op1_minhash_dedup")
def op1_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all documents."""
    return minhash.near_dedup(_table(spark, sf_dir, "documents"))


@_query("op6_embedding_dedup")
def op6_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of all embeddings by cosine."""
    return grid_join.cosine_links(_table(spark, sf_dir, "embeddings"))


END_ID = 2


@_query("op5_token_files")
def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Place, length and checksum of every document's ids, as read back from the files."""
    path = Scratch(spark).path("token_files", keep=True)
    rans.write_tokens(_table(spark, sf_dir, "documents"), path, read_spec(WORD_BPE), END_ID)
    return rans.read_tokens(spark, path).select(
        "doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32")
    )


@_query("op8_line_dedup")
def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lines of every document that match a line before them."""
    return line_dedup.repeated_lines(_table(spark, sf_dir, "documents"))


@_query("op13_embedding_whitening")
def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every embedding on the 16 leading components of the distinct embeddings."""
    table = whitening.whiten(_table(spark, sf_dir, "embeddings"))
    return table.withColumn("deviation", F.col("deviation").try_cast("long"))


@_query("op11_periodic_runs")
def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of every document, of which one in ten repeats its tail's first words."""
    docs = _table(spark, sf_dir, "documents")
    return periodic_runs.run_report(docs, text=periodic_runs.repeat_tails(F.col("text"), F.col("doc_id")))


_WINDOW_SQL = r"""
WITH d AS (
  SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents),
s AS (
  SELECT doc_id, i, md5(array_to_string(w[i:i + 49], ' ')) AS h
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM d WHERE len(w) >= 50)),
r AS (SELECT doc_id, i, doc_id > min(doc_id) OVER (PARTITION BY h) AS later FROM s),
p AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM d),
c AS (
  SELECT p.doc_id, p.i, word,
         coalesce(max(CASE WHEN later THEN p.i END)
           OVER (PARTITION BY p.doc_id ORDER BY p.i ROWS BETWEEN 49 PRECEDING AND CURRENT ROW), 0) > 0 AS gone
  FROM p LEFT JOIN r ON r.doc_id = p.doc_id AND r.i = p.i),
k AS (
  SELECT doc_id, CAST(sum(CAST(gone AS INT)) AS BIGINT) AS n_removed,
         coalesce(string_agg(word, ' ' ORDER BY i) FILTER (WHERE NOT gone), '') AS kept
  FROM c GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_removed, 0) AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN k ON k.doc_id = d.doc_id
"""


@_query("op12_substring_dedup", _WINDOW_SQL)
def op12_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the 50-word passages that an earlier document holds."""
    return substring_dedup.repeat_report(_table(spark, sf_dir, "documents"))
