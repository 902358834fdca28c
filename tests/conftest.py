"""One session for all tests."""

import os
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
DATA = Path(os.environ.get("TESTDATA", "/root/testdata"))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession

    shared = tmp_path_factory.mktemp("shared")
    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.checkpoint.dir", str(shared))
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir() -> str:
    return str(DATA / "sf0.001")


@pytest.fixture(scope="session")
def duck(sf_dir):
    import duckdb

    con = duckdb.connect()
    for path in Path(sf_dir).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return con


@pytest.fixture(scope="session")
def same_rows(spark, sf_dir, duck):
    """Asserts that a query and its SQL give the same columns and rows."""

    def plain(value):
        return f"{value:.6f}" if isinstance(value, float) else repr(value)

    def check(query, sql: str) -> None:
        frame = query(spark, sf_dir)
        columns = sorted(frame.columns)
        cursor = duck.execute(sql)
        named = [d[0] for d in cursor.description]
        assert sorted(named) == columns
        wanted = sorted(tuple(plain(row[named.index(c)]) for c in columns) for row in cursor.fetchall())
        assert sorted(tuple(map(plain, row)) for row in frame.select(*columns).collect()) == wanted

    return check
