"""Shared helpers: tables in the shared scratch folder, fresh column names, SQL-only let-binding."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterable

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space between words in every contract here: space and \t \n \v \f \r.
SPACES = "\t\n\x0b\x0c\r "


def scratch(spark: SparkSession) -> str:
    """A new folder under ``spark.checkpoint.dir``, which driver and executors share.

    If the setting is missing, a local master gets a temporary folder; a cluster raises, because a
    machine-local folder would lose data with its executor.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        base = tempfile.mkdtemp(prefix="geotrace-llm-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/geotrace-llm-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str, partition_by: Iterable[str] = ()) -> DataFrame:
    """Write ``df`` once as Parquet in the shared scratch folder and read it back.

    This cuts the lineage: a lost executor only costs a re-read, and later scans see pruned columns and
    known sizes (so Spark itself decides on broadcasts by the measured size).
    """
    path = f"{scratch(df.sparkSession)}/{name}"
    df.write.option("compression", "zstd").partitionBy(*partition_by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fresh(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` has it (Spark compares without case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def without(df: DataFrame, *names: str) -> DataFrame:
    """``df`` without input columns that clash with an operator's output names."""
    clash = {n.lower() for n in names}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in clash])


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once a row, also when ``body`` uses it inside lambdas."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def ascii_lower(c: Column) -> Column:
    """A-Z to a-z, all other characters as they are."""
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words_of(text: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text; null and blank texts have none."""
    flat = F.translate(F.coalesce(text, F.lit("")), SPACES[:-1], " " * 5)
    return F.filter(F.split(flat, " "), lambda w: w != "")


def held_out(doc_id: Column, modulus: int, remainder: int) -> Column:
    """crc32(doc_id as text) mod ``modulus`` = ``remainder``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % modulus == remainder


def bit_filter(df: DataFrame, bit: Column, bits: int) -> np.ndarray:
    """A map of ``2**bits`` bits (eight a byte, lowest first) with the bits ``bit`` of all rows set.

    Its size doesn't depend on the rows; segments of 4 KB are put together by Spark. ``bits`` is 15 at least.
    """
    segment = F.shiftright(bit, 15).alias("segment")
    maps = df.groupBy(segment).agg(F.bitmap_construct_agg(bit.bitwiseAND((1 << 15) - 1)).alias("map"))
    whole = np.zeros(1 << (bits - 3), np.uint8)
    for r in maps.toLocalIterator():  # at most 2**(bits - 15) rows
        whole[r["segment"] << 12:(r["segment"] + 1) << 12] = np.frombuffer(r["map"], np.uint8)
    return whole
