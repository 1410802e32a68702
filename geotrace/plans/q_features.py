"""Registered feature queries."""

from __future__ import annotations

from geotrace.operators.features import FEATURE_KIND, FEATURE_NAMES, extract_features
from geotrace.plans import oracle
from geotrace.plans.registry import register
from geotrace.plans.rounding import round_frame
from geotrace.sources.fixtures import gps_trajectories

FEATURE_GROUPS = {
    "feat_position": ["start_lat", "start_lon", "end_lat", "end_lon", "mean_lat", "mean_lon", "std_lat",
                      "std_lon", "median_lat", "median_lon", "centroid_lat", "centroid_lon"],
    "feat_geometry": ["total_distance", "mean_distance", "std_distance", "straight_distance", "straightness",
                      "lat_range", "lon_range", "area_bbox", "aspect_ratio", "num_points", "density",
                      "centroid_to_end_distance", "centroid_to_end_ratio"],
    "feat_speed": ["avg_speed_ms", "max_speed_ms", "avg_acc_ms2", "max_acc_ms2", "speed_p10", "speed_p50",
                   "speed_p90", "acc_p10", "acc_p50", "acc_p90", "speed_p5", "speed_p15", "speed_p85",
                   "speed_p95"],
    "feat_direction": ["bearing", "bearing_sin", "bearing_cos", "direction_variance", "avg_direction_change",
                       "curvature", "total_turning_angle", "n_significant_turns", "start_end_vs_last_angle",
                       "direction_consistency"],
    "feat_percentiles": ["seg_p5", "seg_p10", "seg_p15", "seg_p25", "seg_p50", "seg_p75", "seg_p85", "seg_p90",
                         "seg_p95", "seg_max", "seg_mean", "seg_std", "bearing_p5", "bearing_p10",
                         "bearing_p15", "bearing_p50", "bearing_p85", "bearing_p90", "bearing_p95"],
    "feat_trend": ["lat_slope", "lat_intercept", "lon_slope", "lon_intercept", "trend_magnitude",
                   "trend_bearing"],
    "feat_poly": ["lat_poly_a", "lat_poly_b", "lat_poly_c", "lon_poly_a", "lon_poly_b", "lon_poly_c",
                  "poly_curvature"],
    "feat_moments": ["seg_skewness", "seg_kurtosis", "speed_skewness", "speed_kurtosis", "bearing_skewness",
                     "bearing_kurtosis"],
    "feat_last_segment": ["last_bearing", "last_speed", "last_direction_change", "last_segment_speed",
                          "last_segment_bearing", "last_acceleration", "prev_direction_change",
                          "direction_change_trend", "remaining_distance"],
}
FLAGSHIP = ["total_distance", "straight_distance", "straightness", "num_points"]


def _make(names):
    def build(spark, sf_dir):
        f = extract_features(gps_trajectories(spark, sf_dir), names)
        return round_frame(f, FEATURE_KIND)
    return build


register("path_distance", oracle.features_sql(FLAGSHIP))(_make(FLAGSHIP))
register("features_all", oracle.features_sql(FEATURE_NAMES))(_make(FEATURE_NAMES))
for _k, _names in FEATURE_GROUPS.items():
    register(_k, oracle.features_sql(_names))(_make(_names))
