import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from calforge.session import apply_defaults
    s = (SparkSession.builder.master("local[4]")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="calforge-test-ckpt-"))
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    apply_defaults(s)
    yield s


def rows(df, *cols):
    """Collected rows as plain tuples (selected columns), sorted."""
    sel = df.select(*cols) if cols else df
    return sorted(tuple(r) for r in sel.collect())
