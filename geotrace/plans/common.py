"""Inputs shared by registered queries: cleaned splits and their feature tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geotrace.operators import quality
from geotrace.operators.features import FEATURE_KIND, FEATURE_NAMES, extract_features
from geotrace.plans.rounding import round_frame
from geotrace.session import stored
from geotrace.sources.fixtures import gps_trajectories


def clean_split(spark, sf_dir: str, split: str) -> DataFrame:
    return quality.clean(gps_trajectories(spark, sf_dir)).where(F.col("split") == split)


def clean_splits(spark, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Cleaned train and test, derived and written once: statistics and both splits read that table."""
    both = stored(quality.clean(gps_trajectories(spark, sf_dir)))
    return both.where("split = 'train'"), both.where("split = 'test'")


def split_features(spark, sf_dir: str, split: str, rounded: bool = False) -> DataFrame:
    """Features of a cleaned split with ``dest_lat, dest_lon, ingest_seq`` carried along."""
    f = extract_features(clean_split(spark, sf_dir, split), keep=["dest_lat", "dest_lon", "ingest_seq"])
    return round_frame(f, FEATURE_KIND) if rounded else f


FEATURES = FEATURE_NAMES


def materialized_features(spark, sf_dir: str, split: str, rounded: bool = False) -> DataFrame:
    """:func:`split_features` written once: queries that take several statistics of the
    same table (quantiles, distinct counts, correlations) then read it instead of re-deriving it."""
    return stored(split_features(spark, sf_dir, split, rounded))
