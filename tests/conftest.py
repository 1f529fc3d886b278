import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from starloom.session import SESSION_DEFAULTS

    b = SparkSession.builder.master("local[*]").config("spark.sql.shuffle.partitions", "8")
    for k, v in SESSION_DEFAULTS.items():
        b = b.config(k, v)
    s = b.getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    # tests set their own checkpoint folder (a cluster names a shared one)
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="starloom-test-ckpt-"))
    yield s
    s.stop()
