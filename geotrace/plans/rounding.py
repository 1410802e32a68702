"""Comparison rounding, applied as the last projection of registered queries.

Trig and summation order differ between engines in the last digits, so both the Spark
query and its SQL twin round by unit: metres and degree angles to 6 decimals,
coordinates in degrees to 9 (they are multiples of 1e-6, so 6 would hit .5 ties),
dimensionless values and radians to 9, slopes and parabola coefficients (~1e-5) to 10.
Counts are not rounded.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DIGITS = {"m": 6, "deg": 6, "coord": 9, "unit": 9, "rad": 9, "small": 10, "km": 6}


def rnd(col: Column | str, kind: str) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    if kind == "count":
        return c.cast("double")
    return F.round(c.cast("double"), DIGITS[kind])


def round_sql(expr: str, kind: str) -> str:
    if kind == "count":
        return f"CAST({expr} AS DOUBLE)"
    return f"round(CAST({expr} AS DOUBLE), {DIGITS[kind]})"


def round_frame(df: DataFrame, kinds: dict[str, str]) -> DataFrame:
    return df.select(*[rnd(c, kinds[c]).alias(c) if c in kinds else F.col(c) for c in df.columns])
