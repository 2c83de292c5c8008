"""Driver contract: entry() runs, every query has a callable and (nearly) all an oracle."""

from __future__ import annotations

import math

import duckdb
import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"
TYPE_NAMES = {
    "string": "VARCHAR",
    "double": "DOUBLE",
    "bigint": "BIGINT",
    "int": "INTEGER",
    "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP",
    "float": "FLOAT",
}
TABLES = "events documents embeddings".split()


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns[0] == "image_id"


def test_oracle_keys_are_queries():
    assert set(E.oracle_sql()) <= set(E.queries())


def _norm(rows):
    def n(v):
        if isinstance(v, float):
            return "NaN" if math.isnan(v) else round(v, 6)
        if hasattr(v, "isoformat"):
            return v.isoformat()
        return v

    return sorted((tuple(n(x) for x in r) for r in rows), key=repr)


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_matches_oracle_at_smallest_sf(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = E.queries()[name](spark, SF)
    cur = con.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(ocols)
    rel_types = dict(zip(con.sql(E.oracle_sql()[name]).columns, map(str, con.sql(E.oracle_sql()[name]).types)))
    spark_types = {f.name: TYPE_NAMES.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in df.schema.fields}
    assert spark_types == rel_types
    orows = [tuple(r[ocols.index(c)] for c in df.columns) for r in cur.fetchall()]
    assert _norm([tuple(r) for r in df.collect()]) == _norm(orows)
