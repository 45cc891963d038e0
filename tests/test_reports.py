"""Profiles, funnel and freshness reports on literal inputs."""

from __future__ import annotations

import datetime as dt
import math

from helpers import event, records, rows
from pyspark.sql import functions as F

from campaignlake.operators import (
    freshness,
    funnel_linkage,
    funnel_orphans,
    funnel_rates,
    campaign_metrics,
    layer_counts,
    layer_freshness,
    line_revenue,
    quarantine,
    raw_profile,
    to_raw,
    type_counts,
    typed_events,
    typed_profile,
    viewability_check,
)


def _raw(spark, payloads):
    return to_raw(records(spark, payloads))


def test_profiles_and_conservation(spark):
    ps = [event("impression", "i1"), event("impression", "i1"), event("click", "c1"), "{bad"]
    raw = _raw(spark, ps)
    typed = typed_events(raw)
    assert set(rows(raw_profile(raw), "event_type", "count")) == {("impression", 2), ("click", 1), (None, 1)}
    prof = {r.event_type: r for r in typed_profile(typed).collect()}
    assert prof["impression"].total == prof["impression"].distinct_events == 1
    approx = {r.event_type: r.distinct_events for r in typed_profile(typed, approximate=True).collect()}
    assert approx == {"impression": 1, "click": 1}
    assert rows(type_counts(typed), "event_type", "events") == [("click", 1), ("impression", 1)]
    counts = dict(rows(layer_counts(raw, typed), "layer", "rows"))
    assert counts == {"raw": 4, "typed": 2, "quarantine": 1, "duplicates": 1}
    assert quarantine(raw).count() == 1
    empty = dict(rows(layer_counts(raw.limit(0), typed.limit(0)), "layer", "rows"))
    assert empty == {"raw": 0, "typed": 0, "quarantine": 0, "duplicates": 0}


def test_funnel_links_and_orphans(spark):
    ps = [
        event("impression", "i1"),
        event("click", "c1", impression_id="i1"),
        event("click", "c2", impression_id="missing"),
        event("click", "c3"),
        event("conversion", "v1", click_id="c1", revenue=4.5),
        event("conversion", "v2", click_id=None, revenue=1.0),
    ]
    typed = typed_events(_raw(spark, ps))
    f = funnel_linkage(typed).first()
    assert (f.impressions, f.clicks, f.linked_clicks, f.conversions, f.linked_conversions, f.linked_revenue) == (
        1, 3, 1, 2, 1, 4.5)
    got = rows(funnel_orphans(typed), "event_id", "ref_type", "reason")
    assert got == [("c2", "impression", "dangling_ref"), ("c3", "impression", "missing_ref"),
                   ("v2", "click", "missing_ref")]


def test_rates_viewability_line_revenue(spark):
    ps = [
        event("impression", "i1", viewable=True, viewable_seconds=0.5),
        event("impression", "i2", viewable=None, viewable_seconds=3.0),
        event("click", "c1"),
        event("conversion", "v1", revenue=10.5, quantity=3),
    ]
    typed = typed_events(_raw(spark, ps))
    r = funnel_rates(typed).first()
    assert (r.ctr, r.cvr, r.expected_ctr, r.expected_cvr) == (0.5, 1.0, 0.02, 0.05)
    v = viewability_check(typed).first()
    assert (v.impressions, v.viewable_flagged, v.viewable_by_seconds, v.mismatches) == (2, 1, 1, 2)
    lr = line_revenue(typed).first()
    assert (lr.unit_price, lr.line_revenue, lr.revenue_matches) == (3.5, 10.5, True)


def test_freshness_against_fixed_clock(spark):
    ts = dt.datetime(2024, 1, 1, 12, 0, 0)
    raw = to_raw(records(spark, [event("click", "c1")], ts=ts))
    as_of = F.lit("2024-01-01 12:20:00").cast("timestamp")
    f = freshness(raw, as_of=as_of).first()
    assert (f.records, f.staleness_minutes, f.within_sla) == (1, 20.0, True)
    late = freshness(raw, as_of=F.lit("2024-01-01 13:00:00").cast("timestamp")).first()
    assert late.within_sla is False and f.max_ingest_delay_seconds > 0


def test_freshness_of_each_layer(spark):
    raw = _raw(spark, [event("impression", "i1"), event("click", "c1"), "{bad"])
    typed = typed_events(raw)
    newest = typed.agg(F.max("event_timestamp")).first()[0]
    as_of = F.lit(newest + dt.timedelta(minutes=10))
    out = {r.layer: r for r in layer_freshness(raw, typed, campaign_metrics(typed), as_of=as_of).collect()}
    assert {k: r.rows for k, r in out.items()} == {"raw": 3, "typed": 2, "metrics": 1}
    assert out["raw"].staleness_minutes == out["typed"].staleness_minutes == 10.0
    assert out["metrics"].newest_event == dt.datetime.combine(newest.date(), dt.time())
    assert out["typed"].within_sla and all(r.newest_write for r in out.values())
    none = layer_freshness(raw.limit(0), typed.limit(0), campaign_metrics(typed.limit(0)), as_of=as_of)
    assert {(r.rows, r.newest_event, r.within_sla) for r in none.collect()} == {(0, None, None)}


def test_funnel_linkage_sums_revenues_without_decimal_form(spark):
    revenues = {
        "fits": [0.1, 0.2, None], "large": [1.0, 2e28], "nan": [1.0, float("nan")], "inf": [float("inf"), 5.0],
        "unlinked": [3.0],
    }
    data = []
    for c, values in revenues.items():
        data += [("click", f"{c}-{k}", c, None, None) for k in range(len(values))]
        data += [("conversion", f"{c}-v{k}", c, f"{c}-{k}", v) for k, v in enumerate(values)]
    data.append(("conversion", "u", "unlinked", "no click", 1e30))
    typed = spark.createDataFrame(
        data, "event_type string, event_id string, campaign_id string, click_id string, revenue double"
    ).withColumn("impression_id", F.lit(None).cast("string"))
    got = {r.campaign_id: r.linked_revenue for r in funnel_linkage(typed).collect()}
    assert math.isnan(got.pop("nan"))
    assert got == {"fits": 0.3, "large": 2e28, "inf": math.inf, "unlinked": 3.0}
