import os

import duckdb
import pytest
from pyspark.sql import SparkSession

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="session")
def spark():
    session = SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8").config("spark.ui.enabled", "false").config("spark.driver.memory", "6g").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture(scope="session")
def sql():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


def plain(rows):
    def value(x):
        return repr(round(x, 8)) if isinstance(x, float) else str(x)

    return sorted(tuple(value(x) for x in r) for r in rows)


@pytest.fixture(scope="session")
def same(spark, sql):
    def check(query, text):
        df = query(spark, SF)
        names = sorted(df.columns)
        got = plain(df.select(*names).collect())
        cur = sql.execute(text)
        have = [c[0] for c in cur.description]
        assert sorted(have) == names
        at = [have.index(n) for n in names]
        assert got == plain([tuple(r[i] for i in at) for r in cur.fetchall()])

    return check
