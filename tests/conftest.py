import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    s = (SparkSession.builder.master("local[4]").appName("quality_lake_tests")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.ui.enabled", "false")
         .config("spark.driver.extraJavaOptions", "-XX:-DontCompileHugeMethods")
         .config("spark.sql.session.timeZone", "America/New_York")
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="ql-test-ckpt-"))
    yield s
    s.stop()


@pytest.fixture
def tmp_dir():
    return tempfile.mkdtemp(prefix="ql-test-")


@pytest.fixture(params=[("true", "UTC"), ("false", "America/New_York")],
                ids=["ansi-utc", "legacy-ny"])
def session_modes(request, spark):
    """Run a test under both ANSI settings and two session time zones."""
    ansi, tz = request.param
    old = (spark.conf.get("spark.sql.ansi.enabled"), spark.conf.get("spark.sql.session.timeZone"))
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    spark.conf.set("spark.sql.session.timeZone", tz)
    yield spark
    spark.conf.set("spark.sql.ansi.enabled", old[0])
    spark.conf.set("spark.sql.session.timeZone", old[1])


def plan_text(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
