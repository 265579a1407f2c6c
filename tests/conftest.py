import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
os.environ["PYTHONPATH"] = sys.path[0] + ":" + os.environ.get("PYTHONPATH", "")


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    s = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "4g")
        .getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


DATA = "/root/testdata"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def oracle(sql: str, sf: str = "sf0.001"):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{DATA}/{sf}/{t}.parquet')")
    return con.execute(sql).df()


def same(ours, theirs) -> None:
    """Equal columns and, in any order, equal rows."""
    cols = sorted(ours.columns)
    assert cols == sorted(theirs.columns)
    order = lambda d: d[cols].astype(str).sort_values(cols).reset_index(drop=True)
    x, y = order(ours), order(theirs)
    assert len(x) == len(y)
    assert x.equals(y), x.compare(y).head()
