"""The driver contract."""

from __future__ import annotations

import __spark_entry__ as entry_mod

from campaignlake.plans import QUERIES
from campaignlake.schemas import METRICS_COLUMNS


def test_entry_returns_flagship_metrics(spark):
    df = entry_mod.entry(spark)
    assert df.columns == [c for c in METRICS_COLUMNS if c != "updated_at"]
    assert df.count() > 0


def test_queries_and_oracles_line_up():
    q, o = entry_mod.queries(), entry_mod.oracle_sql()
    assert set(o) <= set(q)
    assert not {n for n in set(q) - set(o) if n in QUERIES}
