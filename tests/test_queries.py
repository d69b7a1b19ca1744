"""Registered queries against their SQL twins on the smallest tables."""

import os

import duckdb
import pytest

from quillstone.plans import linking, payloads, stores

TABLES = "/root/testdata/sf0.001"
NAMES = "region nation customer supplier part orders lineitem events documents pages labels".split()
SLOW = {"src04_runs", "adm01_sources", "lnk39_partition_statistics", "lnk12_catalogue_links", "gld09_records", "gld07_claims"}
FOUND = {n: (m.QUERIES[n], sql) for m in (payloads, linking, stores) for n, sql in m.ORACLE_SQL.items() if n not in SLOW}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in NAMES:
        con.execute(f"create view {name} as select * from '{TABLES}/{name}.parquet'")
    return con


def plain(rows):
    return sorted(tuple(str(round(x, 6)) if isinstance(x, float) else str(x) for x in r) for r in rows)


@pytest.mark.skipif(not os.path.exists(TABLES), reason="needs the driver's tables")
@pytest.mark.parametrize("name", sorted(FOUND))
def test_query_equals_sql(spark, duck, name):
    make, sql = FOUND[name]
    got = make(spark, TABLES)
    columns = sorted(got.columns)
    cursor = duck.execute(sql)
    order = [c[0] for c in cursor.description]
    assert sorted(order) == columns
    want = [tuple(r[order.index(c)] for c in columns) for r in cursor.fetchall()]
    assert plain(got.select(*[f"`{c}`" for c in columns]).collect()) == plain(want)
