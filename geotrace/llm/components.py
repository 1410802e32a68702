"""Connected components of an edge table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geotrace.llm.common import stored
from geotrace.llm.skew import salted_join


def _star(edges: DataFrame, large: bool, rows: int) -> DataFrame:
    """Tie each vertex's larger (large star) or smaller-or-own (small star) neighbours to its least neighbour.

    The centre of a large component has very many neighbours: its row of the least neighbours is salted.
    """
    if large:
        near = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        near = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = stored(near.groupBy("a").agg(F.least("a", F.min("b")).alias("m"), F.count("*").alias("n")), "least")
    joined = salted_join(near, least.select("a", "m"), "a", least.select("a", "n"), total=rows)
    if large:
        out = joined.where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        out = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).union(
            least.select("a", F.col("m").alias("b")))
    return out.where("a <> b").distinct()


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(vertex, root) for every vertex of an edge table of longs; root is the least vertex reachable.

    Self-loops and repeated edges are allowed; an empty table gives an empty one. The loop ends when a
    round changes nothing (compared by row count and hash sum); every round is a written table, so a lost
    executor never repeats more than one round.
    """
    now = stored(edges.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a <> b").distinct(), "edges")

    def state(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    before = None
    while True:
        seen = state(now)
        if seen == before or not seen[0]:
            break
        before = seen
        now = stored(_star(_star(now, True, seen[0]), False, seen[0]), "edges")
    return now.select(F.col("a").alias("vertex"), F.col("b").alias("root"))
