"""Every query that has an oracle gives the oracle's rows on the smallest tables."""

import glob
import math

import duckdb
import pytest
from loomgraph.plans import catalog
from loomgraph.sources.adapter import TABLES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def oracle():
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        if glob.glob(f"{SF}/{t}.parquet"):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 9)
    return v.isoformat() if hasattr(v, "isoformat") else v


def rows(names, data):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], sorted((tuple(plain(r[i]) for i in order) for r in data), key=str)


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_oracle(spark, oracle, name):
    df = catalog.QUERIES[name](spark, SF)
    rel = oracle.sql(catalog.ORACLES[name])
    assert rows(df.columns, [tuple(r) for r in df.collect()]) == rows(list(rel.columns), rel.fetchall())


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() == 7
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
