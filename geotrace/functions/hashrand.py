"""Deterministic pseudo-randomness from hashes.

``rand(seed)`` depends on partitioning and task order, so results would change with
the cluster layout. A hash of (seed, key columns, tag) gives the same draw for a row
wherever it is processed.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

_MANTISSA = (1 << 53) - 1


def uniform(seed: int, *cols, tag: str = "") -> Column:
    """Uniform draw in [0, 1) from ``xxhash64(seed, tag, cols...)``."""
    h = F.xxhash64(F.lit(int(seed)), F.lit(tag), *[F.col(c) if isinstance(c, str) else c for c in cols])
    return (h.bitwiseAND(F.lit(_MANTISSA))).cast("double") / F.lit(float(1 << 53))


def uniform_md5(seed: int, tag: str, *cols) -> Column:
    """Uniform draw in [0, 1) from the first 52 bits of ``md5(seed:tag:col:...)``, which any SQL engine can repeat."""
    parts = [F.lit(f"{int(seed)}:{tag}"), *[(F.col(c) if isinstance(c, str) else c).cast("string") for c in cols]]
    digits = F.substring(F.md5(F.concat_ws(":", *parts)), 1, 13)
    return F.conv(digits, 16, 10).cast("double") / F.lit(float(1 << 52))


def uniform_range(lo: float, hi: float, seed: int, *cols, tag: str = "") -> Column:
    return F.lit(lo) + (F.lit(hi) - F.lit(lo)) * uniform(seed, *cols, tag=tag)


def normal(seed: int, *cols, tag: str = "") -> Column:
    """Standard normal draw by Box-Muller on two hashed uniforms."""
    u1 = F.lit(1.0) - uniform(seed, *cols, tag=tag + "#1")  # (0, 1]
    u2 = uniform(seed, *cols, tag=tag + "#2")
    return F.sqrt(F.lit(-2.0) * F.log(u1)) * F.cos(F.lit(2 * math.pi) * u2)


def poisson1(seed: int, *cols, tag: str = "") -> Column:
    """Poisson(1) draw (bootstrap weight) by inverting the CDF on one hashed uniform.

    The table goes on until the tail is below the resolution of the draw (2**-53)."""
    u = uniform(seed, *cols, tag=tag)
    cdf, term = [], math.exp(-1)
    while term > 2.0 ** -54:
        cdf.append((cdf[-1] if cdf else 0.0) + term)
        term /= len(cdf)
    expr = F.lit(float(len(cdf)))
    for k in range(len(cdf) - 1, -1, -1):
        expr = F.when(u < F.lit(cdf[k]), F.lit(float(k))).otherwise(expr)
    return expr
