import tempfile

import pytest
from pyspark.sql import SparkSession

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .appName("tests")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="spark-", dir="/tmp"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def grid(spark):
    """Pixel table from rows of numbers (None for NULL), one scene per picture."""

    def make(*pictures, value="dn"):
        rows = [
            (s, r, c, x)
            for s, picture in enumerate(pictures)
            for r, line in enumerate(picture)
            for c, x in enumerate(line)
        ]
        return spark.createDataFrame(rows, f"scene_id int, r int, c int, {value} int")

    return make


@pytest.fixture(scope="session")
def picture():
    """The first scene of a pixel table as rows of numbers."""

    def make(df, value, scene=0):
        rows = [r for r in df.collect() if r["scene_id"] == scene]
        h, w = max(r["r"] for r in rows) + 1, max(r["c"] for r in rows) + 1
        out = [[None] * w for _ in range(h)]
        for r in rows:
            out[r["r"]][r["c"]] = r[value]
        return out

    return make
