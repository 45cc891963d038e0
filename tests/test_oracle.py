"""Every registered query against its SQL oracle (DuckDB) on the small
dataset: same row count, same columns, same values (order-insensitive)."""

from __future__ import annotations

import os
import sys

import pytest
from helpers import SF_SMALL

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

from compare import duck, norm  # noqa: E402

from campaignlake.plans import ORACLE_SQL, QUERIES  # noqa: E402

SKIP = {"stream_raw", "stream_typed", "stream_metrics", "stream_metrics_incremental", "stream_metrics_two_drains",
        "stream_progress"}  # covered in test_streaming


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def _lines(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted("|".join(norm(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", sorted(n for n in QUERIES if n in ORACLE_SQL and n not in SKIP))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF_SMALL)
    s_rows = [tuple(r) for r in df.collect()]
    res = con.execute(ORACLE_SQL[name])
    d_cols = [d[0] for d in res.description]
    d_rows = res.fetchall()
    assert sorted(df.columns) == sorted(d_cols)
    assert len(s_rows) == len(d_rows)
    assert _lines(df.columns, s_rows) == _lines(d_cols, d_rows)


def test_every_query_has_an_oracle_or_is_timing_only():
    assert set(QUERIES) == set(ORACLE_SQL)
