"""Registered queries of this subpackage, with their DuckDB SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rollwise.llm import html, langid, merkle, mixing, pieces, quality, secrets, simhash, substrings, trie, urls, vptree, whitening
from rollwise.llm.common import read

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE_SQL[name] = sql.strip()
        return fn

    return deco


@query(
    "op10_quality_rules",
    f"""
WITH {quality.oracle()}
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept FROM judged
""",
)
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(read(spark, sf_dir, "documents"))


@query("op4_simhash_near_dedup")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(read(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.hex_fingerprint().alias("fingerprint"), "component_id")


@query("op9_secret_scans")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(read(spark, sf_dir, "documents"))


OP1 = """
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
win AS (SELECT rid, i, md5(array_to_string(w[i : i + 34], ' ')) AS k FROM (SELECT rid, w, unnest(range(1, len(w) - 33)) AS i FROM d WHERE len(w) > 34)),
rep AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY k) AS c FROM win) WHERE c > 1),
gone AS (SELECT DISTINCT rid, unnest(range(i, i + 35)) AS p FROM rep),
kept AS (SELECT d.rid, string_agg(u.word, ' ' ORDER BY u.p) AS t, count(*) AS n
  FROM d, LATERAL (SELECT unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p) u
  LEFT JOIN gone g ON g.rid = d.rid AND g.p = u.p WHERE g.p IS NULL GROUP BY d.rid)
SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (rid)
"""


@query("op1_substring_dedup", OP1)
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.digests(read(spark, sf_dir, "documents"))


@query("op7_url_filters")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(read(spark, sf_dir, "pages"))


@query("op8_html_extraction")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract(read(spark, sf_dir, "pages"))


@query("op5_language_id")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.predict(read(spark, sf_dir, "documents"))


@query("op6_nearest_neighbours")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vptree.nearest(read(spark, sf_dir, "embeddings"))


@query("op3_mixing_sources")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.schedule(read(spark, sf_dir, "documents"))


@query("op2_sentencepiece_sampling")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.sampled(read(spark, sf_dir, "documents"))


@query("op12_document_fingerprints", merkle.oracle())
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.edited(read(spark, sf_dir, "documents"))


@query("op13_embedding_whitening")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(read(spark, sf_dir, "embeddings"))


@query("op11_conversation_trie", trie.oracle())
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.conversation_trie(read(spark, sf_dir, "conversations"))
