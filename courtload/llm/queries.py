"""Registered queries of the corpus operators, and SQL where it can express them."""

from __future__ import annotations

import zlib
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from courtload.llm import (alignment, block_names, bpe_chunks, hilbert, lang_id, licenses, multi_index, near_dups, packing,
                           periodic_runs, secret_scan, url_rules, warc)
from courtload.llm.common import field_type, scratch_path, table

ALLOW_RULES = ("example.net/en/", "org/fr/")
BLOCK_RULES = ("net/", "example.com/de/")


def op1_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_rules.judge(table(spark, sf_dir, "pages"), ALLOW_RULES, BLOCK_RULES)


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id",
                         "offset")


def op3_near_dups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dups.classes(table(spark, sf_dir, "documents")).drop("row")


def op4_bpe_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_chunks.digests(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op5_block_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return block_names.groups(table(spark, sf_dir, "documents")).drop("row")


def op6_multi_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return multi_index.groups(table(spark, sf_dir, "embeddings"))


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages, folder = table(spark, sf_dir, "pages"), scratch_path(spark, "warc")
    warc.write(pages, folder)
    return warc.read(spark, folder, field_type(pages, "page_id"), payloads=False).select(
        F.col("page").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to")


def op8_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def op9_lang_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = lang_id.fit(docs.where(~lang_id.held_out()))
    return lang_id.predict(docs, model, ["doc_id", lang_id.held_out().alias("held_out")])


def op10_hilbert(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hilbert.shards(table(spark, sf_dir, "documents"), ["lang", "source", "n_chars"])


def _repeated_tail(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """The words of a tenth of the documents repeat from some place on, with a period that their id gives."""
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 or not words:
        return words
    n, g = len(words), h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + (words[a:a + p] * (1 + (n - a) // p))[:n - a]


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs.find(table(spark, sf_dir, "documents"), change=_repeated_tail)
    lines = F.transform("runs", lambda r: F.format_string("%d,%d,%d\n", r["start"], r["length"], r["period"]))
    return found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), periodic_runs.longest().alias("longest"),
                        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
                        F.sha2("collapsed", 256).alias("collapsed_sha256")).select(
        "doc_id", "n_runs", "longest.start", "longest.length", "longest.period",
        F.floor(1000 * F.col("longest.length") / F.col("longest.period")).alias("exponent_milli"), "runs_sha256", "collapsed_sha256")


def op12_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.find(table(spark, sf_dir, "documents"))
    kinds = [r.kind for r in secret_scan.BASE]

    def of(*names: str) -> Column:
        return F.filter("spans", lambda s: s["kind"].isin(*names))

    def listed(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    return found.select(
        "doc_id", *[F.size(of(k)).cast("long").alias(f"n_{k}") for k in kinds],
        F.sha2(listed(of(*kinds)), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"))


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.scores(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
                            public_tokenizers.path("piece_bpe_32k.model"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_url_rules": op1_url_rules,
    "op2_packing": op2_packing,
    "op3_near_dups": op3_near_dups,
    "op4_bpe_chunks": op4_bpe_chunks,
    "op5_block_names": op5_block_names,
    "op6_multi_index": op6_multi_index,
    "op7_warc": op7_warc,
    "op8_licenses": op8_licenses,
    "op9_lang_id": op9_lang_id,
    "op10_hilbert": op10_hilbert,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_secret_scan": op12_secret_scan,
    "op13_alignment": op13_alignment,
}

ORACLE: dict[str, str] = {
    "op1_url_rules": r"""
WITH parts AS (
  SELECT page_id, coalesce(regexp_extract(url, '^.*?://([^/?#]*)', 1, 's'), '') AS raw_host,
         coalesce(regexp_extract(url, '^.*?://[^/?#]*([^?#]*)', 1, 's'), '') AS path
  FROM pages),
hosts AS (
  SELECT page_id, translate(raw_host, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, path FROM parts),
fits AS (
  SELECT *, (host = 'net' OR host LIKE '%.net') AND path LIKE '/%' AS net,
         (host = 'example.net' OR host LIKE '%.example.net') AND path LIKE '/en/%' AS net_en,
         (host = 'example.com' OR host LIKE '%.example.com') AND path LIKE '/de/%' AS com_de,
         (host = 'org' OR host LIKE '%.org') AND path LIKE '/fr/%' AS org_fr
  FROM hosts)
SELECT page_id, host, path,
       CASE WHEN net_en THEN 'example.net/en/' WHEN com_de THEN 'example.com/de/' WHEN org_fr THEN 'org/fr/'
            WHEN net THEN 'net/' END AS rule,
       CASE WHEN net_en OR org_fr THEN 'allow' WHEN com_de OR net THEN 'block' ELSE 'allow' END AS verdict
FROM fits""",
    "op7_warc": """
WITH payloads AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest
  FROM pages),
firsts AS (
  SELECT *, min(page_id) OVER (PARTITION BY payload_digest, payload_bytes) AS first FROM payloads)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 100 AND first <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND first <> page_id THEN first END AS refers_to
FROM firsts""",
    "op5_block_names": r"""
WITH texts AS (
  SELECT doc_id, length(coalesce(text, '')) AS chars,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
  FROM documents),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY text_sha256 ORDER BY chars DESC, doc_id) AS place,
         first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY chars DESC, doc_id) AS keep_id,
         count(*) OVER (PARTITION BY text_sha256) AS group_size
  FROM texts)
SELECT doc_id, keep_id, group_size, place = 1 AS kept, text_sha256 FROM ranked""",
}
