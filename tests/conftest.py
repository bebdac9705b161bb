import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from strata.session import DEFAULT_CONF
    ckpt = tempfile.mkdtemp(prefix="strata-test-ckpt-", dir="/tmp")
    b = SparkSession.builder.master("local[4]").appName("strata-tests")
    for k, v in DEFAULT_CONF.items():
        b = b.config(k, v)
    b = (b.config("spark.sql.shuffle.partitions", "4").config("spark.driver.memory", "6g")
          .config("spark.checkpoint.dir", ckpt))
    s = b.getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    s.sparkContext.setCheckpointDir(ckpt)
    yield s
    s.stop()


def rows(df, *cols):
    """Sorted list of tuples of the given columns (all columns when none)."""
    cols = cols or tuple(df.columns)
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)
