"""Every registered query against its SQL, on the smallest benchmark tables."""

import math
from collections import Counter

import duckdb
import pytest

from veracat.workload import REGISTRY

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    con.sql("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{sf}/{name}.parquet'")
    return con


def plain(v):
    return round(v, 9) if isinstance(v, float) and not math.isnan(v) else v


def bag(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(plain(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_query_matches_its_sql(spark, sf, duck, name):
    build, sql = REGISTRY[name]
    df = build(spark, sf)
    got = bag(df.columns, [tuple(r) for r in df.collect()])
    if sql is None:
        return
    relation = duck.sql(sql)
    assert sorted(df.columns) == sorted(relation.columns)
    assert got == bag(relation.columns, relation.fetchall())
