"""Every query of the engine against its SQL in DuckDB, at the smallest scale."""

import math
from pathlib import Path

import duckdb
import pytest

from tidemark.plans import catalog, live, network, requests, serving

SF = "/root/testdata/sf0.001"


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 9)
    return str(v) if v is not None else None


def rows(names, data):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in data), key=str)


assert live and network and requests and serving  # their queries are in the catalog


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query(spark, name):
    got = catalog.QUERIES[name](spark, SF)
    data = [tuple(r) for r in got.collect()]
    if name not in catalog.ORACLE_SQL:
        assert data
        return
    con = duckdb.connect()
    for p in Path(SF).glob("*.parquet"):
        con.execute(f"create view {p.stem} as select * from '{p}'")
    want = con.execute(catalog.ORACLE_SQL[name])
    names = [c[0] for c in want.description]
    assert sorted(names) == sorted(got.columns)
    assert rows(got.columns, data) == rows(names, want.fetchall())
