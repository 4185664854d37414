import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession
    os.environ.setdefault("BENCH_CPUS", "4")
    builder = (SparkSession.builder.master("local[4]").appName("workpulse-tests")
               .config("spark.sql.shuffle.partitions", "4")
               .config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false")
               .config("spark.sql.session.timeZone", "UTC")
               .config("spark.sql.codegen.hugeMethodLimit", "8000")
               .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="wp-test-wh-")))
    s = builder.getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="wp-test-ckpt-"))
    yield s
