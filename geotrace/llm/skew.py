"""Joins of rows with one-row-a-key tables where one key may hold a third of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A key is split if it holds over one in SHARE of all rows, so at most SHARE keys are split.
SHARE = 1000
ROWS_A_SALT = 4096


def salted_join(rows: DataFrame, keyed: DataFrame, key: str, counts: DataFrame, n: str = "n", how: str = "inner",
                least: int = ROWS_A_SALT, total: int | None = None) -> DataFrame:
    """``rows`` joined with ``keyed`` (at most one row for each key) on ``key``; null keys are equal to each other.

    ``counts`` has (key, ``n``), the exact number of ``rows`` by key, and ``total`` their sum (or less), if known.
    Keys over ``least`` rows and over a thousandth of all rows are spread over one salt for each ``least`` rows,
    with their row of ``keyed`` repeated for each salt. That list has at most a thousand keys by its own rule,
    so it is broadcast.
    """
    if total is None:
        total = counts.agg(F.sum(n)).first()[0] or 0
    floor = max(least, total // SHARE)
    hot_, salts, salt, other, other_salt = (_fresh(rows, keyed, c) for c in ("hot", "salts", "salt", "other", "other_salt"))
    hot = counts.where(F.col(n) > floor).select(F.col(key).alias(hot_), F.ceil(F.col(n) / least).cast("int").alias(salts))
    left = rows.join(F.broadcast(hot), F.col(key).eqNullSafe(F.col(hot_)), "left").drop(hot_)
    spread = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.col(salts)).cast("int")
    left = left.withColumn(salt, F.coalesce(spread, F.lit(0))).drop(salts)
    more = keyed.join(F.broadcast(hot.where(F.col(salts) > 1)), F.col(key).eqNullSafe(F.col(hot_))).drop(hot_)
    more = more.withColumn(other_salt, F.explode(F.sequence(F.lit(1), F.col(salts) - 1))).drop(salts)
    right = keyed.withColumn(other_salt, F.lit(0)).unionByName(more).withColumnRenamed(key, other)
    on = F.col(key).eqNullSafe(F.col(other)) & (F.col(salt) == F.col(other_salt))
    return left.join(right, on, how).drop(other, salt, other_salt)


def _fresh(rows: DataFrame, keyed: DataFrame, name: str) -> str:
    taken = {c.lower() for c in [*rows.columns, *keyed.columns]}
    while name in taken:
        name = "_" + name
    return name
