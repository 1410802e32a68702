"""Registered preparation queries (M1-M4) and folds.

They run on the rounded feature table of the cleaned training split, which is
identical in both engines (see ``features_all``), so statistics on it can be compared.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from geotrace.operators import prepare as P
from geotrace.operators.features import FEATURE_NAMES
from geotrace.operators.validation import fold_integrity, group_folds
from geotrace.plans import oracle
from geotrace.plans.common import materialized_features
from geotrace.plans.registry import register
from geotrace.plans.rounding import rnd, round_sql

K_FOLDS = 10
SEED = 42


def _sql(select: str, *more: str) -> str:
    ctes = [*oracle.feature_ctes(), oracle.CLEAN_TRAIN,
            oracle.feature_table_cte("tf_", "trajectory_id IN (SELECT trajectory_id FROM ctr)",
                                     FEATURE_NAMES, rounded=True), *more]
    return oracle.with_derived(*ctes) + "\n" + select


def _low_var_sql() -> str:
    parts = []
    for i, k in enumerate(FEATURE_NAMES):
        parts.append(f"SELECT '{k}' AS feature, count(DISTINCT {k}) AS n_unique, stddev_samp({k}) AS std, "
                     f"count(*) AS n FROM tf_")
    body = " UNION ALL ".join(parts)
    return _sql(f"""SELECT feature, CAST(n_unique AS BIGINT) AS n_unique, round(std, 9) AS std,
  (n_unique <= 1 OR n_unique / greatest(1, n) < {P.QUASI_CONSTANT_SHARE} OR coalesce(std <= {P.MIN_STD}, FALSE))
    AS dropped
FROM ({body})""")


@register("low_variance", _low_var_sql())
def low_variance(spark, sf_dir):
    t = materialized_features(spark, sf_dir, "train", rounded=True)
    s = P.low_variance_stats(t, FEATURE_NAMES)
    return s.select("feature", "n_unique", F.round("std", 9).alias("std"), "dropped")


def _xy_sql_expr():
    dx = (f"((radians(dest_lon) - radians(start_lon)) * cos((radians(dest_lat) + radians(start_lat)) / 2) "
          f"* {oracle.R_M})")
    dy = f"((radians(dest_lat) - radians(start_lat)) * {oracle.R_M})"
    return dx, dy


_DX, _DY = _xy_sql_expr()


@register("local_target", _sql(f"""SELECT trajectory_id,
  CASE WHEN dest_lat IS NULL OR dest_lon IS NULL THEN 0.0 ELSE {round_sql(_DX, 'm')} END AS dx,
  CASE WHEN dest_lat IS NULL OR dest_lon IS NULL THEN 0.0 ELSE {round_sql(_DY, 'm')} END AS dy FROM tf_"""))
def local_target(spark, sf_dir):
    t = P.local_target(materialized_features(spark, sf_dir, "train", rounded=True))
    return t.select("trajectory_id", rnd("dx", "m").alias("dx"), rnd("dy", "m").alias("dy"))


SCALE_COLS = FEATURE_NAMES


def _robust_sql() -> str:
    q = ", ".join(f"quantile_cont({k}, [0.25, 0.5, 0.75]) AS q_{k}" for k in SCALE_COLS)
    cols = ", ".join(
        f"round(({k} - q.q_{k}[2]) / (CASE WHEN q.q_{k}[3] - q.q_{k}[1] = 0 THEN 1 "
        f"ELSE q.q_{k}[3] - q.q_{k}[1] END), 6) AS {k}" for k in SCALE_COLS)
    return _sql(f"SELECT trajectory_id, {cols} FROM tf_, qs_ q", f"qs_ AS (SELECT {q} FROM tf_)")


def _standard_sql() -> str:
    cols = ", ".join(
        f"round(({k} - avg({k}) OVER ()) / coalesce(nullif(stddev_pop({k}) OVER (), 0), 1), 6) AS {k}"
        for k in SCALE_COLS)
    return _sql(f"SELECT trajectory_id, {cols} FROM tf_")


def _scaled(kind):
    def build(spark, sf_dir):
        t = materialized_features(spark, sf_dir, "train", rounded=True)
        sc = P.fit_scaler(t, SCALE_COLS, kind)
        return sc.transform(t).select("trajectory_id", *[F.round(c, 6).alias(c) for c in SCALE_COLS])
    return build


register("robust_scale", _robust_sql())(_scaled("robust"))
register("standard_scale", _standard_sql())(_scaled("standard"))


def _kbest_sql() -> str:
    f = " UNION ALL ".join(
        f"SELECT '{k}' AS feature, {i} AS pos, corr({k}, dx) AS r, count(*) AS n FROM lt_"
        for i, k in enumerate(SELECT_COLS))
    lt = (f"lt_ AS (SELECT *, CASE WHEN dest_lat IS NULL OR dest_lon IS NULL THEN 0.0 ELSE {_DX} END AS dx "
          f"FROM tf_)")
    return _sql(f"""SELECT feature, round(f, 6) AS f_score,
  CAST(row_number() OVER (ORDER BY f DESC NULLS LAST, pos) AS INTEGER) AS rank
FROM (SELECT feature, pos, CASE WHEN r IS NULL OR isnan(r) THEN NULL ELSE r * r / (1 - r * r) * (n - 2) END AS f
      FROM ({f}))""", lt)


SELECT_COLS = FEATURE_NAMES


@register("select_k_best", _kbest_sql())
def select_k_best(spark, sf_dir):
    t = P.local_target(materialized_features(spark, sf_dir, "train", rounded=True))
    s = P.f_scores(t, SELECT_COLS, "dx")
    return s.select("feature", F.round("f_score", 6).alias("f_score"), "rank")


_FOLD = f"CAST((('0x' || substr(md5('{SEED}:' || trajectory_id), 1, 8))::BIGINT) % {K_FOLDS} AS INTEGER)"


@register("fold_groups", oracle.with_derived(oracle.CLEAN_TRAIN) + f"""
SELECT fold, count(*) AS rows, count(DISTINCT trajectory_id) AS groups, CAST(0 AS BIGINT) AS straddling_groups
FROM (SELECT trajectory_id, {_FOLD} AS fold FROM ctr) GROUP BY fold""")
def fold_groups(spark, sf_dir):
    from geotrace.plans.common import clean_split
    f = group_folds(clean_split(spark, sf_dir, "train"), K_FOLDS, "trajectory_id", SEED)
    return fold_integrity(f)


def _h32(expr: str) -> str:
    return f"(('0x' || substr(md5('{SEED}:' || CAST({expr} AS VARCHAR)), 1, 8))::BIGINT)"


@register("fold_balanced", oracle.with_derived(oracle.CLEAN_TRAIN) + f"""
SELECT trajectory_id, CAST((row_number() OVER (ORDER BY {_h32('ingest_seq')}, ingest_seq) - 1) % {K_FOLDS} AS INTEGER)
  AS fold FROM ctr""")
def fold_balanced(spark, sf_dir):
    """E1 (shuffled K-fold, sizes differ by at most one): rank in hashed order, fold = rank mod k."""
    from geotrace.operators.validation import balanced_folds
    from geotrace.plans.common import clean_split
    f = balanced_folds(clean_split(spark, sf_dir, "train"), K_FOLDS, "ingest_seq", SEED)
    return f.select("trajectory_id", "fold")


@register("fold_group_balanced", oracle.with_derived(oracle.CLEAN_TRAIN) + f"""
SELECT trajectory_id, CAST((row_number() OVER (ORDER BY gs DESC, {_h32('trajectory_id')}, trajectory_id) - 1)
  % {K_FOLDS} AS INTEGER) AS fold
FROM (SELECT trajectory_id, count(*) AS gs FROM ctr GROUP BY trajectory_id)""")
def fold_group_balanced(spark, sf_dir):
    """E2 size-balanced: groups by size (desc), then hash, take folds round-robin."""
    from geotrace.operators.validation import balanced_group_folds
    from geotrace.plans.common import clean_split
    f = balanced_group_folds(clean_split(spark, sf_dir, "train"), K_FOLDS, "trajectory_id", SEED)
    return f.select("trajectory_id", "fold")
