"""Registered queries against their SQL, on the smallest tables."""

import math

import duckdb
import pandas as pd
import pytest

from seaswath.plans import queries
from seaswath.plans.queries import QUERIES, SQL

SF = "/root/testdata/sf0.001"
TABLES = ("events", "embeddings", "lineitem", "part", "orders", "customer", "supplier", "nation", "region", "documents")


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_as_sql(spark, con, name):
    got, want = QUERIES[name](spark, SF).toPandas(), con.execute(SQL[name]).df()
    columns = sorted(want.columns)
    assert sorted(got.columns) == columns
    got, want = (x[columns].sort_values(columns).reset_index(drop=True) for x in (got, want))
    pd.testing.assert_frame_equal(got, want, check_dtype=False, rtol=0, atol=1e-9)


def test_every_query_is_known():
    assert set(SQL) <= set(QUERIES) and len(QUERIES) > 60


def test_bent_track_of_long_lines(spark, monkeypatch):
    """Pings whose squares pass an int's range: each part of the first one of two paints a straight row of pixels."""
    n = 60_000
    rows = spark.createDataFrame([(0, n + i, [float(v) for v in range(64)]) for i in range(2)], "line int, ping int, bs array<double>")
    monkeypatch.setattr(queries.views, "waterfall", lambda *_: rows)
    x, y = ([500 + p * 1.7 for p in (n, n + 1)], [300 + p * 2.9 - p * p * 0.021 for p in (n, n + 1)])
    parts = math.ceil(math.hypot(x[1] - x[0], y[1] - y[0]))
    a = math.atan2(x[1] - x[0], y[1] - y[0])
    want = {}
    for sub in range(parts + 1):
        for k in range(64):
            t = (k - 32) * 20 / 32
            e, s = x[0] + sub / parts * (x[1] - x[0]) + t * math.cos(a), y[0] + sub / parts * (y[1] - y[0]) - t * math.sin(a)
            at = int(max(y) + 20 - s), int(e - min(x) + 20)
            if k == 0 or at != last:
                want[at] = k + 1
            last = at
    assert {(r.row, r.col): r.value for r in QUERIES["geocode_tile"](spark, "").collect()} == want
    for name in ("gap_fill", "gap_fill_east_west"):
        assert want.items() <= {(r.row, r.col): r.value for r in QUERIES[name](spark, "").collect()}.items()
