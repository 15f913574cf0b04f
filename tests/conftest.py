from __future__ import annotations

import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from basketry.session import build_session

    spark = build_session("basketry-tests", master="local[8]", shuffle_partitions=8,
                          extra={"spark.driver.memory": "4g"})
    # tests own no cluster: give the checkpoint root a fresh local folder
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="basketry-test-ckpt-"))
    yield spark
    spark.stop()


@pytest.fixture(scope="session")
def sf_small():
    if not os.path.exists(f"{SF_SMALL}/events.parquet"):
        pytest.skip("fixture tables not present")
    return SF_SMALL
