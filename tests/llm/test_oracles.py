import glob

import duckdb
import pytest
from loomgraph.llm import queries
from loomgraph.sources.adapter import TABLES

SF = "/root/testdata/sf0.001"


def rows(names, data):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], sorted((tuple(round(r[i], 9) if isinstance(r[i], float) else r[i] for i in order) for r in data), key=str)


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_oracle(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        if glob.glob(f"{SF}/{t}.parquet"):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    df, rel = queries.QUERIES[name](spark, SF), con.sql(queries.ORACLES[name])
    assert rows(df.columns, [tuple(r) for r in df.collect()]) == rows(list(rel.columns), rel.fetchall())
