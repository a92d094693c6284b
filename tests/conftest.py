import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    builder = (SparkSession.builder.master("local[4]").appName("urbanpulse-tests")
               .config("spark.sql.shuffle.partitions", "8")
               .config("spark.ui.enabled", "false")
               .config("spark.sql.session.timeZone", "UTC"))
    s = builder.getOrCreate()
    s.sparkContext.setLogLevel("OFF")
    # tests only: a checkpoint folder of our own where the session names none
    if not s.sparkContext.getCheckpointDir() and not s.conf.get("spark.checkpoint.dir", None):
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="up-test-ckpt-"))
    yield s
    s.stop()


def rows(df, *cols):
    """Collect as a list of tuples (selected columns, input order kept)."""
    sel = df.select(*cols) if cols else df
    return [tuple(r) for r in sel.collect()]
