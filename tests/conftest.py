import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from strata.session import DEFAULT_CONF, ensure_checkpoint_dir

    b = SparkSession.builder.master("local[4]").appName("strata-tests")
    for k, v in DEFAULT_CONF.items():
        b = b.config(k, v)
    s = (b.config("spark.sql.shuffle.partitions", "8")
         .config("spark.eventLog.enabled", "true").config("spark.eventLog.compress", "false")
         .config("spark.eventLog.rolling.enabled", "false").config("spark.eventLog.buffer.kb", "1k")
         .config("spark.eventLog.dir", "file://" + tempfile.mkdtemp(prefix="strata-test-events-"))
         .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="strata-test-warehouse-"))
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(s, tempfile.mkdtemp(prefix="strata-test-ckpt-"))
    yield s
    s.stop()


def rows(df, *cols):
    """Sorted list of tuples (None-safe)."""
    sel = df.select(*cols) if cols else df
    return sorted((tuple(r) for r in sel.collect()), key=lambda t: tuple((x is None, str(x)) for x in t))
