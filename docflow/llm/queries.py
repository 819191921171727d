"""Registered queries of this package: one for each operator, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docflow.llm import (bestfit, bpe, embeddings, licenses, packing, quality, rules, search, secrets, simhash,
                         toxicity, urls, whitening)
from docflow.llm.common import table

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
WORDS = public_tokenizers.path("word_bpe_49k.json")


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    encoded = bpe.encode(docs, RANKS, ["doc_id"])
    keys = ["doc_id", "n_tokens", "ids_sha256"]
    hashed = encoded.withColumn("ids_sha256", F.sha2(bpe.ENCODED, 256))
    decoded = bpe.decode(hashed, RANKS, keys)
    return decoded.select(*keys, F.sha2(bpe.DECODED, 256).alias("decoded_sha256"))


def op2_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan(table(spark, sf_dir, "documents"), ["doc_id"])
    base = F.filter("spans", lambda s: s["place"] < len(secrets.BASE))

    def n(kind: str):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id", n("assign"), n("access"), n("hex"),
        F.sha2(secrets.listed(base).cast("binary"), 256).alias("base_sha256"),
        secrets.listed(F.col("spans")).alias("spans"),
    )


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.judged(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")), ["doc_id"])


def op4_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan(table(spark, sf_dir, "documents"), ["doc_id"])
    starts = F.transform("places", lambda p: p["at"].cast("long"))
    base = F.transform("places", lambda p: p["label"])
    more = F.transform("found", lambda f: f["label"])

    def joined(labels):
        return F.array_join(F.array_sort(F.array_distinct(labels)), ",")

    return found.select(
        "doc_id", "n_words", F.size("places").cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"),
        joined(base).alias("base_labels"), joined(F.concat(base, more)).alias("labels"), "score",
    )


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    digits = F.lower(F.lpad(F.hex("fingerprint"), 16, "0"))
    return found.select("doc_id", digits.alias("fingerprint"), "component_id")


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.judged(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(packing.tokenized(table(spark, sf_dir, "documents"), WORDS))
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


def op8_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_duplicates(table(spark, sf_dir, "embeddings"))


def op9_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judged(table(spark, sf_dir, "pages"))


def op10_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = rules.apply(table(spark, sf_dir, "documents"), ["doc_id"], ["lang", "source"])
    return found.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        F.array_join("failed", ",").alias("failed"),
    )


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    whitened, _ = whitening.whiten(table(spark, sf_dir, "embeddings"))
    return whitened


def op12_bestfit(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces, _ = bestfit.pack(table(spark, sf_dir, "documents"), WORDS, digest=F.crc32)
    return pieces.select("doc_id", "piece", "start", "length", F.col("ids").alias("ids_crc32"), "sequence_id", "offset")


def op13_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    found, _ = search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_bpe, op2_secrets, op3_toxicity, op4_licenses, op5_simhash, op6_quality,
                            op7_packing, op8_embeddings, op9_urls, op10_rules, op11_whitening,
                            op12_bestfit, op13_search)
}
_TERMS = ("regexp_extract_all(translate(coalesce({0}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', "
          "'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')")

SQL: dict[str, str] = {
    # Every document scored for every item by brute force.
    "op13_search": f"""
WITH d AS (
  SELECT doc_id, row_number() OVER () AS r, {_TERMS.format('text')} AS terms FROM documents),
stats AS (
  SELECT count(*) FILTER (WHERE len(terms) > 0)::BIGINT AS big_n, coalesce(sum(len(terms)), 0)::BIGINT AS big_l FROM d),
occ AS (SELECT r, doc_id, len(terms)::BIGINT AS n, unnest(terms) AS term FROM d),
tf AS (SELECT r, doc_id, n, term, count(*)::BIGINT AS tf FROM occ GROUP BY r, doc_id, n, term),
df AS (SELECT term, count(*)::BIGINT AS df FROM tf GROUP BY term),
q AS (SELECT DISTINCT item_id, term FROM (SELECT item_id, unnest({_TERMS.format('text')}) AS term FROM benchmark)),
w AS (SELECT term, floor(1000 * ln((2.0 * big_n + 2) / (2.0 * df + 1)))::BIGINT AS w FROM df, stats),
scored AS (
  SELECT q.item_id, tf.r, tf.doc_id,
         sum(w.w * ((1000000000 * tf.tf) // (1000 * tf.tf + 8 * (10 + (90 * tf.n * s.big_n) // s.big_l))))::BIGINT AS score
  FROM q JOIN tf ON q.term = tf.term JOIN w ON w.term = q.term, stats AS s
  GROUP BY q.item_id, tf.r, tf.doc_id),
ranked AS (
  SELECT item_id, doc_id, score,
         row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id ASC NULLS FIRST, r) AS rank
  FROM scored WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM ranked WHERE rank <= 10
""",
}
