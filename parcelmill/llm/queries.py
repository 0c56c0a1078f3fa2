"""Registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelmill import session
from parcelmill.llm import backoff, exact, licences, lines, mixing, packing, periods, personal, phrases, quality, simhash, substrings, winnowing

LEARN_MODULUS, LEARN_HELD = 7, 2  # of op4: documents whose remainder is this one aren't learned from
LABEL_MODULUS, LABEL_HELD = 4, 2  # of op6: labels of such documents aren't used

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        session.tune(spark)
        return fn(spark, sf_dir)

    QUERIES[fn.__name__] = run
    return fn


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def remainder(modulus: int) -> Column:
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % modulus


@_query
def op1_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal.digest_rows(personal.personal_data(_table(spark, sf_dir, "documents")))


@_query
def op2_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(_table(spark, sf_dir, "documents"), distance=4, shingle=4)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@_query
def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = substrings.without_repeats(_table(spark, sf_dir, "documents"), length=35)
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


@_query
def op4_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return backoff.scores(_table(spark, sf_dir, "documents"), remainder(LEARN_MODULUS) != LEARN_HELD)


@_query
def op5_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licences.licences(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", *[F.array_join(c, ",").alias(c) for c in ("sentence_ids", "licences")])


def quality_model(spark: SparkSession, sf_dir: str) -> quality.Model:
    """The classifier of a folder's documents and labels, without the held-out labels."""
    docs, labels = (_table(spark, sf_dir, t) for t in ("documents", "labels"))
    return quality.train(docs, labels, remainder(LABEL_MODULUS) != LABEL_HELD)


@_query
def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = quality.scores(_table(spark, sf_dir, "documents"), quality_model(spark, sf_dir))
    held = (remainder(LABEL_MODULUS) == LABEL_HELD).alias("held_out")
    return scored.select("doc_id", held, "score", (F.col("score") >= quality.THRESHOLD).cast("int").alias("predicted"))


@_query
def op7_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return winnowing.contamination(*[_table(spark, sf_dir, t) for t in ("documents", "benchmark")], window=13)


@_query
def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.exact_duplicates(_table(spark, sf_dir, "documents"))


@_query
def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = lines.clean_runs(_table(spark, sf_dir, "documents"))
    return cleaned.select("doc_id", "n_lines", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


@_query
def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"), capacity=4096)


@_query
def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periods.collapsed(_table(spark, sf_dir, "documents"), source=periods.made_periodic)
    return periods.digest_rows(found)


@_query
def op12_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(_table(spark, sf_dir, "documents"))


@_query
def op13_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.taken(_table(spark, sf_dir, "documents"))


ORACLES["op11_periodic_runs"] = periods.oracle()
ORACLES["op12_phrase_collocations"] = phrases.oracle()
ORACLES["op13_source_mixing"] = mixing.oracle()
ORACLES["op5_licence_scan"] = licences.oracle()

ORACLES["op8_exact_dedup"] = """
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id = max(doc_id) OVER g AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW g AS (PARTITION BY coalesce(text, ''))"""

ORACLES["op3_substring_dedup"] = r"""
WITH w AS (SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words
           FROM documents),
starts AS (SELECT doc_id, unnest(range(1, len(words) - 33)) AS p FROM w WHERE len(words) >= 35),
windows AS (SELECT s.doc_id, p, array_to_string(words[p:p + 34], ' ') AS t FROM starts s JOIN w USING (doc_id)),
again AS (SELECT t FROM windows GROUP BY t HAVING count(*) > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(p, p + 35)) AS i FROM windows JOIN again USING (t)),
flat AS (SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS i FROM w),
left_ AS (SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS kept, count(*) AS n
          FROM flat ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
SELECT w.doc_id, len(words)::BIGINT AS n_words, (len(words) - coalesce(n, 0))::BIGINT AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM w LEFT JOIN left_ USING (doc_id)"""
