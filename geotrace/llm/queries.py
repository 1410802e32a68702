"""The registered queries of this subpackage: thin digests of the operators' outputs under the contracts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from geotrace.llm import (minhash, mixing, packing, ppm, quality_classifier, quality_rules, sharding, simhash, spelling, syncmers, url_filter,
                          vector_codes, warc)
from geotrace.llm.common import held_out, stored

PIECES = ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")

SHARD_BYTES = 1 << 20

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(f):
        QUERIES[name] = f
        if sql is not None:
            ORACLE[name] = sql
        return f
    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op3_simhash_neardup")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return simhash.near_groups(docs, shingle=4, max_bits=4).select("doc_id", "fingerprint", "component_id")


@query("op6_quality_rules", f"""WITH {quality_rules.rules_sql()}
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept FROM judged""")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return quality_rules.judged(docs).select("doc_id", *quality_rules.STATS, "base_failed", "kept")


@query("op8_syncmers")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return syncmers.edited_pairs(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query("op10_url_filter")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judged(table(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict")


@query("op4_quality_classifier")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = (table(spark, sf_dir, t) for t in ("documents", "labels"))
    out, _ = quality_classifier.scored(docs.select("doc_id", "text"), labels.select("doc_id", "quality"))
    return out.select("doc_id", held_out(F.col("doc_id"), 4, 2).alias("held_out"), "score",
                      (F.col("score") >= 0.7).cast("int").alias("predicted"))


@query("op1_packing")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    from public_tokenizers import path

    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return packing.pack(docs, path("word_bpe_49k.json"), with_ids=False).select(*PIECES)


@query("op5_mixing", mixing.mixing_sql())
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "lang", "text")
    rows = stored(mixing.with_topic(docs).drop("text"), "topics")  # whole texts are read once
    return mixing.mixed(rows).select("doc_id", "topic", "n_tokens", "probability", "kept")


@query("op9_ppm")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ppm.scored(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query("op7_warc")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"))


@query("op2_sharding", sharding.sharding_sql(SHARD_BYTES))
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.sharded(table(spark, sf_dir, "documents").select("doc_id", "text"), SHARD_BYTES, keep_text=False)


@query("op12_spelling", spelling.variants_sql())
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query("op13_vector_codes", vector_codes.codes_sql())
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    out, _ = vector_codes.compressed(table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label"))
    return out.select("vec_id", "code", "error", "label_error", "codebooks_sha256")


@query("op11_minhash", minhash.groups_sql())
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = minhash.near_groups(table(spark, sf_dir, "documents").select("doc_id", "text"), shingle=4, percent=80)
    return out.select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))
