"""geotrace: GPS-trajectory destination analytics on Spark.

Trajectory tables (one row per path, with ``path_lat`` / ``path_lon`` arrays) are
parsed, cleaned, screened for outliers, clustered, turned into 96 numeric
features, and fed to two-target regressors scored by great-circle distance.
Everything is DataFrame / SQL / Spark ML; see README.md for the layout.
"""

__version__ = "0.1.0"
