"""Every registered query against its SQL on the smallest tables."""

import math
import os

import duckdb
import pytest

from chronopulse.queries import ORACLES, QUERIES

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6) + 0.0
    if isinstance(v, (list, tuple)):
        return tuple(plain(x) for x in v)
    return v if v is None or isinstance(v, (bool, int, str)) else plain(float(v)) if hasattr(v, "as_tuple") else str(v)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    frame = QUERIES[name](spark, SF)
    columns = sorted(frame.columns)
    got = sorted((tuple(plain(r[c]) for c in columns) for r in frame.collect()), key=repr)
    if name not in ORACLES:
        assert got
        return
    cursor = duck.execute(ORACLES[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == columns
    want = sorted((tuple(plain(r[names.index(c)]) for c in columns) for r in cursor.fetchall()), key=repr)
    assert got == want


def test_raw_matrix_holds_its_whole_range(spark, duck):
    """g16 shows every tick of the fragments that start from 0 on, in the query and in its SQL."""
    ids = [i for (i,) in duck.execute("select vec_id from embeddings").fetchall()]
    starts = {i * 400 + r * 160 for i in ids for r in range(1 + i % 4)}
    want = {(t + k * 10) // 10 for t in starts if 0 <= t < 100_000 for k in range(16) if t + k * 10 < 100_000}
    name = "g16_raw_records_matrix"
    assert {r[0] for r in QUERIES[name](spark, SF).select("time_bin").distinct().collect()} == want
    assert {i for (i,) in duck.execute(f"select distinct time_bin from ({ORACLES[name]})").fetchall()} == want
