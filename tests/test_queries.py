"""Every query with SQL gives the SQL's rows; entry() runs; the driver contract holds."""

import math

import duckdb
import pytest

import __spark_entry__ as entry_module
from cropledger.plans import registry

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events".split()


def canonical(value):
    if value is None or isinstance(value, float) and math.isnan(value):
        return ""
    return f"{value:.7g}" if isinstance(value, float) else str(value)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(registry.ORACLE_SQL))
def test_same_rows_as_sql(spark, duck, name):
    df = registry.QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    got = sorted([canonical(r[c]) for c in columns] for r in df.collect())
    want = sorted([canonical(v) for v in r] for r in duck.execute(f"select {', '.join(columns)} from ({registry.ORACLE_SQL[name]})").fetchall())
    assert got == want


def test_contract(spark):
    known = entry_module.queries()
    assert set(entry_module.oracle_sql()) <= set(known) and set(registry.QUERIES) <= set(known)
    assert entry_module.entry(spark).count() > 0
