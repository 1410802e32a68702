import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from geotrace.session import local_session
    s = local_session(cores=4, shuffle_partitions=8, driver_memory="4g", app="geotrace-tests")
    yield s
    s.stop()


@pytest.fixture
def traj_df(spark):
    """Build a trajectory frame from (id, lats, lons, dest_lat, dest_lon) tuples."""
    def make(rows, split="train"):
        data = [(r[0], split, [float(x) for x in r[1]], [float(x) for x in r[2]],
                 None if r[3] is None else float(r[3]), None if r[4] is None else float(r[4]), i)
                for i, r in enumerate(rows)]
        return spark.createDataFrame(
            data, "trajectory_id string, split string, path_lat array<double>, path_lon array<double>, "
                  "dest_lat double, dest_lon double, ingest_seq long")
    return make
