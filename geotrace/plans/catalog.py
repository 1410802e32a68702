"""Imports every query module so that all keys are registered."""

from geotrace.plans import q_cluster, q_eval, q_features, q_io, q_linear, q_models, q_outliers, q_prepare, q_quality  # noqa: F401
