"""Validation, profiling and cleaning.

Profiles are single aggregates. Cleaning works on the unioned train/test frame with a
``split`` column; the first-occurrence dedup is ``row_number() = 1``, which Spark runs
as a map-side group limit first, so an id repeated millions of times leaves each task
as one row.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from geotrace.sources.io import SUBMISSION_COLUMNS

# The id the reference always drops from its training set.
DEFAULT_EXCLUDED_IDS = ["128_20090222093321"]
NUMERIC_COLUMNS = ["start_lat", "start_lon", "end_lat", "end_lon", "dest_lat", "dest_lon"]


def null_profile(df: DataFrame, by: str | None = "split") -> DataFrame:
    """NULL cells over all columns and empty paths, per ``by`` group (V1, V2)."""
    cols = [c for c in df.columns if c != by]
    nulls = sum((F.col(c).isNull().cast("long") for c in cols), F.lit(0).cast("long"))
    aggs = [F.count(F.lit(1)).alias("rows"), F.sum(nulls).alias("null_cells")]
    if "path_lat" in df.columns:
        aggs.append(F.count_if(F.coalesce(F.size("path_lat"), F.lit(0)) == 0).alias("empty_paths"))
    return (df.groupBy(by) if by else df.groupBy()).agg(*aggs)


def data_summary(df: DataFrame) -> DataFrame:
    """Rows, column count and whether a target is present, per split (V3)."""
    return df.groupBy("split").agg(
        F.count(F.lit(1)).alias("rows"),
        F.lit(len([c for c in df.columns if c != "split"])).cast("long").alias("n_columns"),
        F.bool_or(F.col("dest_lat").isNotNull() & F.col("dest_lon").isNotNull()).alias("has_target"))


class MissingColumnsError(ValueError):
    pass


def validate_submission(sub: DataFrame) -> DataFrame:
    """One-row report on a submission (V4): counts, NULLs, ranges, duplicates, range flags.

    Missing required columns raise; everything else is reported, as in the reference.
    """
    missing = [c for c in SUBMISSION_COLUMNS if c not in sub.columns]
    if missing:
        raise MissingColumnsError(f"submission lacks columns {missing}")
    lat, lon = F.col("latitude_pred"), F.col("longitude_pred")
    return sub.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col("trajectory_id").isNull()).alias("null_ids"),
        F.count_if(lat.isNull()).alias("null_lat"), F.count_if(lon.isNull()).alias("null_lon"),
        F.min(lat).alias("min_lat"), F.max(lat).alias("max_lat"),
        F.min(lon).alias("min_lon"), F.max(lon).alias("max_lon"),
        (F.count(F.lit(1)) - F.count_distinct("trajectory_id")).alias("duplicate_ids"),
        F.coalesce(F.bool_and(lat.between(-90, 90)), F.lit(True)).alias("lat_in_range"),
        F.coalesce(F.bool_and(lon.between(-180, 180)), F.lit(True)).alias("lon_in_range"))


def check_submission_columns(sub: DataFrame) -> bool:
    """Stored-file pre-check (V5): are the required columns present?"""
    return all(c in sub.columns for c in SUBMISSION_COLUMNS)


@dataclass
class CleanConfig:
    excluded_ids: list[str] = field(default_factory=lambda: list(DEFAULT_EXCLUDED_IDS))
    min_points: int = 2
    drop_missing_target: bool = True


def _is_train() -> Column:
    return F.col("split") == F.lit("train")


def exclude_ids(df: DataFrame, ids: list[str]) -> DataFrame:
    """Drop listed ids from train rows; NULL ids stay."""
    if not ids:
        return df
    hit = F.coalesce(F.col("trajectory_id").isin(ids), F.lit(False))
    return df.where(~(_is_train() & hit))


def dedup_first(df: DataFrame, keys: tuple[str, ...] = ("split", "trajectory_id"),
                order: str = "ingest_seq") -> DataFrame:
    """One row per key, the one with the smallest ``order`` (first occurrence).

    NULL ids form one group per split, so the first NULL-id row is kept, as pandas does.
    """
    first = F.row_number().over(Window.partitionBy(*keys).orderBy(order))
    return df.withColumn("_rn", first).where("_rn = 1").drop("_rn")


def coerce_numeric(df: DataFrame) -> DataFrame:
    """Numeric columns that exist -> double, bad values -> NULL."""
    out = df
    for c in NUMERIC_COLUMNS:
        if c in df.columns:
            out = out.withColumn(c, F.col(c).cast("string").try_cast("double")
                                 if isinstance(df.schema[c].dataType, T.StringType)
                                 else F.col(c).cast("double"))
    return out


def range_filter(df: DataFrame) -> DataFrame:
    """C4: start/end coordinates in range (inclusive); NULL passes; absent columns skipped."""
    cond = F.lit(True)
    for c, lim in (("start_lat", 90), ("end_lat", 90), ("start_lon", 180), ("end_lon", 180)):
        if c in df.columns:
            cond = cond & (F.col(c).between(-lim, lim) | F.col(c).isNull())
    return df.where(cond)


def ensure_paths(df: DataFrame) -> DataFrame:
    """Path columns exist and are arrays (NULL -> [])."""
    out = df
    empty = F.array().cast("array<double>")
    for c in ("path_lat", "path_lon"):
        out = out.withColumn(c, F.coalesce(F.col(c), empty) if c in df.columns else empty)
    return out


def clean(df: DataFrame, cfg: CleanConfig | None = None) -> DataFrame:
    """C1-C7 on train rows, C2-C5 on test rows, in one plan over the unioned frame."""
    cfg = cfg or CleanConfig()
    out = exclude_ids(df, cfg.excluded_ids)
    out = dedup_first(out)
    out = range_filter(coerce_numeric(out))
    out = ensure_paths(out)
    train = _is_train()
    keep = ~train | (F.size("path_lat") >= cfg.min_points)                       # C6
    if cfg.drop_missing_target:                                                    # C7
        keep = keep & (~train | (F.col("dest_lat").isNotNull() & F.col("dest_lon").isNotNull()))
    return out.where(keep)


def sample_id_check(sub: DataFrame, sample: DataFrame | None) -> DataFrame | None:
    """Ids of the optional sample submission that the submission lacks, and the reverse
    (two left-anti joins, tagged by ``side``); None when there is no sample file."""
    if sample is None:
        return None
    a = sample.select("trajectory_id").distinct()
    b = sub.select("trajectory_id").distinct()
    return (a.join(b, "trajectory_id", "left_anti").withColumn("side", F.lit("missing_in_submission"))
            .unionByName(b.join(a, "trajectory_id", "left_anti").withColumn("side", F.lit("not_in_sample"))))
