import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession
    s = (SparkSession.builder.master("local[4]").appName("radiolens-tests")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.ui.enabled", "false")
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    # tests own their checkpoint folder (a cluster names one in spark.checkpoint.dir)
    if s.sparkContext.getCheckpointDir() is None:
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="radiolens-test-ckpt-"))
    yield s
    s.stop()


@pytest.fixture
def tmp_dir():
    return tempfile.mkdtemp(prefix="radiolens-test-")


def record_line(serving="X:1", payload=None, n_fields=233, fields=None):
    """A version-6 record with blank fields except the given ones."""
    f = [""] * n_fields
    f[0] = "6"
    f[2] = serving
    if n_fields >= 21:
        f[20] = serving
    for pos, v in (fields or {}).items():
        f[pos - 1] = v
    return ";".join(f) + (payload if payload is not None else "|")
