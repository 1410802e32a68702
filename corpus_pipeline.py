"""The corpus pipeline: quality classifier, quality rules, SimHash near-dedup, mixing, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read again as
the next stage's docs. All but the last return the columns of documents as they came, extra ones included;
the last returns the packed pieces with their token ids. Null, empty and very long texts, repeated rows and
empty tables have the results that the operators state.
"""

from __future__ import annotations

from public_tokenizers import path as tokenizer_path
from pyspark.sql import DataFrame, SparkSession

from geotrace.llm import mixing, packing, quality_classifier, quality_rules, simhash
from geotrace.llm.common import stored

#: No twin: random features, Arrow tasks and token ids are beyond SQL; tests hold each stage to its operator.
ORACLE_SQL = None

#: Share of the clean tokens that mixing keeps.
KEEP = 0.6


def classify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose calibrated quality score is at least 0.7."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality")
    return quality_classifier.accepted(docs, labels, threshold=0.7)


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and whose source passes the host rule."""
    return quality_rules.accepted(docs)


def dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates (4-word shingles, at most 4 bits apart)."""
    return simhash.deduplicated(docs, shingle=4, max_bits=4)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``KEEP`` of the tokens, by the tempered source, language and topic marginals; rare cells keep all they have."""
    return mixing.sampled(docs, keep=KEEP)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as pieces of sequences of 4096 tokens, each window with the sources' shares."""
    return packing.pack(docs, tokenizer_path("word_bpe_49k.json"))


STAGES = [("quality classifier", classify), ("quality rules", rules), ("SimHash near-dedup", dedup),
          ("mixing to target weights", mix), ("packing", pack)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows over the documents of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
