"""Signed partials against a full recompute, with late and retracted events."""

from __future__ import annotations

import datetime as dt
import math
import random

import pytest
from helpers import event, records

from campaignlake.operators import campaign_metrics
from campaignlake.operators.deltas import PARTIAL_SCHEMA, merge_partials, metrics_from_partials, signed_partials
from campaignlake.schemas import TYPED_COLUMNS, TYPED_SCHEMA
from campaignlake.sources.tables import read_table
from campaignlake.streaming import deltas
from campaignlake.streaming.layers import LayerPaths, await_query, start_raw_stream, start_typed_stream

COLUMNS = "k int, event_type string, campaign_id string, advertiser_id string, event_timestamp timestamp, viewable boolean, revenue double, quantity int"
ODD = [float("nan"), float("inf"), float("-inf"), 9e27, 9e27, 1e29]


def _events(seed, n=600, odd=False):
    rng = random.Random(seed)
    rows = []
    for k in range(n):
        kind = rng.choice(["impression"] * 4 + ["click", "click", "conversion", "error"])
        at = dt.datetime(2024, 1, rng.randrange(1, 6), 10) if rng.random() < 0.97 else None
        money = rng.choice([0.1, 0.2, 33.33, -4.0, None, *(ODD if odd else [])])
        rows.append((k, kind, rng.choice(["c1", "c2", "c3", None]), rng.choice(["a", "b"]), at,
                     rng.choice([True, False, None]), money, rng.choice([1, 2, None])))
    return rows


def _lines(frame):
    kept = [c for c in frame.columns if c != "updated_at"]
    def plain(v):
        return "nan" if isinstance(v, float) and math.isnan(v) else float(f"{v:.12g}") if isinstance(v, float) else v
    return sorted(str(tuple(plain(r[c]) for c in kept)) for r in frame.collect())


@pytest.mark.parametrize("odd", [False, True])
def test_any_grouping_and_retraction_equals_a_recompute(spark, odd):
    typed = spark.createDataFrame(_events(5, odd=odd), COLUMNS)
    gone = "k % 7 = 3 OR campaign_id = 'c3'"
    parts = [signed_partials(typed.where(f"k % 3 = {m}")) for m in range(3)]
    merged = merge_partials(parts[0].union(parts[1])).union(parts[2]).union(signed_partials(typed.where(gone), -1))
    left = typed.where(f"NOT coalesce({gone}, false)")
    assert _lines(metrics_from_partials(merged)) == _lines(campaign_metrics(left))
    assert _lines(metrics_from_partials(parts[0].union(parts[1]).union(parts[2]))) == _lines(campaign_metrics(typed))


def test_all_taken_back_is_an_empty_table(spark):
    typed = spark.createDataFrame(_events(6, odd=True), COLUMNS)
    both = signed_partials(typed).union(signed_partials(typed, -1))
    assert merge_partials(both).count() == 0 and metrics_from_partials(both).count() == 0
    assert metrics_from_partials(spark.createDataFrame([], PARTIAL_SCHEMA)).count() == 0
    with pytest.raises(ValueError):
        signed_partials(typed, 2)


def test_drains_read_new_rows_only(spark, scratch):
    paths = LayerPaths.under(scratch, source=f"{scratch}/topic")

    def drain(payloads, offset):
        records(spark, payloads, start_offset=offset).write.mode("append").parquet(paths.source)
        await_query(start_raw_stream(spark, paths), 120)
        await_query(start_typed_stream(spark, paths), 120)
        return sum(int(p["numInputRows"]) for p in deltas.drain_deltas(spark, paths, 120))

    assert deltas.partials(spark, paths).count() == 0
    first = [event("impression", f"i{k}", ts=f"2024-01-0{k % 5 + 1}T10:00:00+00:00") for k in range(20)]
    first += [event("conversion", f"v{k}", ts="2024-01-02T11:00:00+00:00", revenue=10.01) for k in range(3)]
    assert drain(first, 0) == 23
    deltas.compact(spark, paths)
    late = [event("click", "late", ts="2024-01-01T09:00:00+00:00"), event("impression", "i3"), event("conversion", "v9", ts="2024-01-02T11:00:00+00:00", revenue=0.1)]
    assert drain(late, 100) == 2  # the copy of i3 is no typed row
    typed = read_table(spark, paths.typed, TYPED_COLUMNS, schema=TYPED_SCHEMA)
    assert _lines(metrics_from_partials(deltas.partials(spark, paths))) == _lines(campaign_metrics(typed))
    assert deltas.generation(spark, paths) == 1
    deltas.compact(spark, paths)
    deltas.compact(spark, paths)
    assert deltas.generation(spark, paths) == 3
    gone = "event_id IN ('v1', 'i0')"
    for _ in range(2):  # a second call replaces the first
        deltas.retract(typed.where(gone), paths, "request_1")
    deltas.write_metrics(spark, paths)
    want = _lines(campaign_metrics(typed.where(f"NOT {gone}")))
    assert _lines(metrics_from_partials(deltas.partials(spark, paths))) == want
    with pytest.raises(ValueError):
        deltas.retract(typed, paths, "a/b")
