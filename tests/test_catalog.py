"""Every query on the small tables against its SQL."""

from decimal import Decimal

import pytest

from ledgerloom import catalog

duckdb = pytest.importorskip("duckdb")
SF = "/root/testdata/sf0.001"
TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "labels")


@pytest.fixture(scope="module")
def con():
    found = duckdb.connect()
    for t in TABLES:
        found.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return found


def plain(v):
    return round(v, 6) if isinstance(v, float) else v.normalize() if isinstance(v, Decimal) else v


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query_equals_sql(spark, con, name):
    rows = catalog.QUERIES[name](spark, SF)
    columns = sorted(rows.columns)
    found = con.execute(catalog.ORACLE_SQL[name])
    place = {d[0]: i for i, d in enumerate(found.description)}
    assert sorted(place) == columns
    got = sorted((tuple(plain(r[c]) for c in columns) for r in rows.collect()), key=str)
    assert got == sorted((tuple(plain(r[place[c]]) for c in columns) for r in found.fetchall()), key=str)


def test_each_rule_finds_something(spark):
    assert catalog.QUERIES["P16_findings_by_rule"](spark, SF).count() == 21
