"""Sharding by extendible hashing: only oversized buckets split on another hash bit, until all fit.

The directory is indexed by the leading bits of a hash of the id. A shard is the shortest prefix whose rows
hold at most ``limit`` bytes, or that has one row only (a row larger than the limit is a shard of its own,
``over_limit``). Rounds of ``STEP`` bits: sums by the longest prefix of the round (added up map-side), all
shorter ones from those; only rows of prefixes that are still too large go to the next round.

Rows with equal ids share all 60 hash bits. If such a key is too large, its rows go on with 60 bits of a
hash of id and row number, so a key with a third of all rows is split like any other bucket.

Null ids hash like the empty text, null texts have no bytes. An empty table gives an empty one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geotrace.llm.common import fresh, stored, without

BITS, STEP = 60, 12


def hash_bits(key: Column) -> Column:
    """60 bits of the MD5 of a text, as zeros and ones."""
    number = F.conv(F.substring(F.md5(F.coalesce(key.cast("string"), F.lit(""))), 1, BITS // 4), 16, 10).cast("long")
    return F.lpad(F.bin(number), BITS, "0")


def sharded(df: DataFrame, limit: int, id_col: str = "doc_id", text_col: str = "text", keep_text: bool = True) -> DataFrame:
    """``df`` (without the text unless ``keep_text``) with ``shard`` (its prefix of hash bits), ``n_bytes``,
    ``shard_bytes``, ``shard_rows`` and ``over_limit``; input columns of those names are replaced."""
    df = without(df, "shard", "n_bytes", "shard_bytes", "shard_rows", "over_limit")
    bits, uid = fresh(df, "bits"), fresh(df, "uid")
    size = F.coalesce(F.octet_length(F.col(text_col)), F.lit(0)).cast("long")
    rows = df.withColumns({"n_bytes": size, bits: hash_bits(F.col(id_col)), uid: F.monotonically_increasing_id()})
    active = stored(rows if keep_text else rows.drop(text_col), "rows")
    out, begin = None, 0
    while True:
        end = begin + STEP
        sums = active.groupBy(F.substring(bits, 1, end).alias("fine")).agg(F.sum("n_bytes").alias("bytes"), F.count("*").alias("n"))
        levels = sums.select("fine", "bytes", "n", F.explode(F.sequence(F.lit(begin), F.lit(end))).alias("depth"))
        levels = levels.withColumn("shard", F.substring("fine", F.lit(1), F.col("depth")))
        whole = levels.groupBy("shard").agg(F.sum("bytes").alias("shard_bytes"), F.sum("n").alias("shard_rows"))
        fits = whole.where((F.col("shard_bytes") <= limit) | (F.col("shard_rows") == 1))
        leaves = levels.select("fine", "shard", "depth").join(fits, "shard").groupBy("fine").agg(
            F.min_by(F.struct("shard", "shard_bytes", "shard_rows"), "depth").alias("leaf"))
        leaves = stored(leaves, "leaves")
        fine = F.substring(bits, 1, end)
        placed = active.withColumn("fine", fine).join(leaves, "fine").drop("fine")
        out = placed if out is None else out.union(placed)
        rest = stored(active.withColumn("fine", fine).join(leaves.select("fine"), "fine", "left_anti").drop("fine"), "rest")
        if rest.isEmpty():
            break
        begin = end
        if begin == BITS:  # whole keys are too large: more bits, from the row numbers
            more = hash_bits(F.concat(F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.lit(":"), F.col(uid).cast("string")))
            rest = rest.withColumn(bits, F.concat(bits, more))
        active = rest
    return out.select(*[F.col(f"`{c}`") for c in active.columns if c not in (bits, uid, "n_bytes")], "leaf.shard", "n_bytes",
                      "leaf.shard_bytes", "leaf.shard_rows", (F.col("leaf.shard_bytes") > limit).alias("over_limit"))


def directory(rows: DataFrame) -> DataFrame:
    """(shard, depth, shard_bytes, shard_rows) of the shards of a sharded table."""
    return rows.groupBy("shard").agg(F.length("shard").alias("depth"), F.first("shard_bytes").alias("shard_bytes"),
                                     F.first("shard_rows").alias("shard_rows"))


def write_shards(rows: DataFrame, path: str) -> None:
    """A Parquet folder for each shard. A shard is within the byte limit, so one task can write it."""
    rows.withColumn("shard", F.concat(F.lit("s"), "shard")).repartition("shard").write.partitionBy("shard").parquet(path)


def sharding_sql(limit: int, table: str = "documents", depth: int = 24) -> str:
    """DuckDB twin for distinct ids; ``depth`` is more than any shard of the small data needs."""
    return f"""WITH d AS (SELECT doc_id, CAST(coalesce(strlen(text), 0) AS BIGINT) AS n_bytes,
  lpad(bin(CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, {BITS // 4}) AS BIGINT)), {BITS}, '0') AS bits FROM {table}),
l AS (SELECT doc_id, n_bytes, k, substr(bits, 1, k) AS shard FROM (SELECT *, unnest(range(0, {depth + 1})) AS k FROM d)),
s AS (SELECT *, sum(n_bytes) OVER w AS shard_bytes, count(*) OVER w AS shard_rows FROM l WINDOW w AS (PARTITION BY k, shard)),
f AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY k) AS r FROM s WHERE shard_bytes <= {limit} OR shard_rows = 1)
SELECT doc_id, shard, n_bytes, CAST(shard_bytes AS BIGINT) AS shard_bytes, CAST(shard_rows AS BIGINT) AS shard_rows,
  shard_bytes > {limit} AS over_limit FROM f WHERE r = 1"""
