import os
import sys
import tempfile

import pytest

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, REPO)
os.environ["PYTHONPATH"] = os.pathsep.join(filter(None, [REPO, os.environ.get("PYTHONPATH")]))
DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    s = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "4g")
        .config("spark.local.dir", tempfile.mkdtemp(prefix="spark-", dir="/tmp"))
        .getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def data():
    return DATA


@pytest.fixture(scope="session")
def duck():
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    return con


@pytest.fixture(scope="session")
def same():
    """Compare two frames without regard to the order of rows and columns."""

    def check(a, b):
        assert sorted(a.columns) == sorted(b.columns)
        cols = sorted(a.columns)
        a, b = (x[cols].sort_values(cols).reset_index(drop=True) for x in (a, b))
        assert len(a) == len(b)
        for c in cols:
            equal = (a[c] == b[c]) | (a[c].isna() & b[c].isna())
            assert equal.all(), (c, a[c][~equal].head(3).tolist(), b[c][~equal].head(3).tolist())

    return check
