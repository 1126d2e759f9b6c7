"""One local session for all tests, and a comparison with SQL."""

import os
import sys
import tempfile

import duckdb
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="session")
def spark():
    from tidemark.session import build

    folder = tempfile.mkdtemp(prefix="spark-tests-")
    session = build("local[4]", **{"spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.driver.memory": "4g", "spark.checkpoint.dir": f"file://{folder}", "spark.sql.warehouse.dir": f"{folder}/warehouse", "spark.ui.showConsoleProgress": "false"})
    session.sparkContext.setLogLevel("OFF")
    return session


@pytest.fixture(scope="session")
def sf_dir():
    return os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def plain(value):
    if isinstance(value, float):
        return "nan" if value != value else f"{value:.9g}"
    if value is None:
        return "~"
    return str(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(plain(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="session")
def same_as_sql(spark, sf_dir):
    def check(query, sql, folder=sf_dir):
        got = query(spark, folder)
        with duckdb.connect() as con:
            for t in TABLES:
                con.sql(f"create view {t} as select * from '{folder}/{t}.parquet'")
            want = con.sql(sql)
            assert rows_of(got.columns, [tuple(r) for r in got.collect()]) == rows_of(want.columns, want.fetchall())

    return check
