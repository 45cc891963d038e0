"""One test per semantic edge case of the layers (literal inputs)."""

from __future__ import annotations

import json

from helpers import event, records, rows
from pyspark.sql import functions as F

from campaignlake.operators import (
    campaign_metrics,
    campaign_metrics_single_pass,
    parse_single_pass,
    parse_three_way,
    quarantine,
    to_raw,
    typed_events,
    unmatched_activity,
)


def _typed(spark, payloads, single_pass=False):
    return typed_events(to_raw(records(spark, payloads)), single_pass=single_pass)


def test_malformed_json_kept_raw_absent_typed_quarantined(spark):
    raw = to_raw(records(spark, ["{bad", event("click", "e_1")]))
    got = {r.eh_offset: r for r in raw.collect()}
    assert got[0].raw_payload == "{bad"
    assert got[0].event_type is None and got[0].campaign_id is None and got[0].event_date is None
    assert rows(_typed(spark, ["{bad", event("click", "e_1")]), "event_id") == [("e_1",)]
    q = quarantine(raw).collect()
    assert [(r.raw_payload, r.reason) for r in q] == [("{bad", "unknown_event_type")]


def test_foreign_payload_is_quarantined(spark):
    probe = json.dumps({"test": True, "source": "x"})
    raw = to_raw(records(spark, [probe]))
    assert raw.first().event_type is None
    assert _typed(spark, [probe]).count() == 0
    assert quarantine(raw).first().reason == "unknown_event_type"


def test_known_type_without_id_goes_to_quarantine_not_dedup(spark):
    no_id = [json.dumps({"event_type": "click", "campaign_id": "c"}) for _ in range(3)]
    raw = to_raw(records(spark, no_id + [event("click", "e_1")]))
    parsed = parse_three_way(raw)
    assert parsed.where(F.col("event_id").isNull()).count() == 3
    assert rows(typed_events(raw), "event_id") == [("e_1",)]
    q = quarantine(raw).collect()
    assert len(q) == 3 and {r.reason for r in q} == {"missing_event_id"}


def test_garbage_timestamp_does_not_kill_the_layer(spark):
    p = event("impression", "e_1", ts="garbage")
    raw = to_raw(records(spark, [p])).first()
    assert raw.event_date is None and raw.event_timestamp == "garbage"
    assert _typed(spark, [p]).first().event_timestamp is None


def test_timestamp_without_microseconds_parses(spark):
    p = event("impression", "e_1", ts="2024-01-05T08:09:10+00:00")
    t = _typed(spark, [p]).select(F.col("event_timestamp").cast("string")).first()[0]
    assert t == "2024-01-05 08:09:10"
    assert to_raw(records(spark, [p])).first().event_date.isoformat() == "2024-01-05"


def test_near_midnight_dates_agree_in_utc(spark):
    p = event("impression", "e_1", ts="2024-01-02T01:30:00+00:00")
    raw_date = to_raw(records(spark, [p])).first().event_date.isoformat()
    metrics_date = campaign_metrics(_typed(spark, [p])).first().event_date.isoformat()
    assert raw_date == metrics_date == "2024-01-02"


def test_near_midnight_dates_split_outside_utc(spark):
    p = event("impression", "e_1", ts="2024-01-02T01:30:00+00:00")
    typed = _typed(spark, [p]).cache()
    typed.count()
    spark.conf.set("spark.sql.session.timeZone", "America/Sao_Paulo")
    try:
        raw_date = to_raw(records(spark, [p])).first().event_date.isoformat()
        metrics_date = campaign_metrics(typed).first().event_date.isoformat()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        typed.unpersist()
    assert (raw_date, metrics_date) == ("2024-01-02", "2024-01-01")


def test_wrongly_typed_fields_become_null(spark):
    p = event("conversion", "e_1", quantity=1.5, revenue="2.5")
    r = _typed(spark, [p]).first()
    assert r.quantity is None and r.revenue is None and r.event_id == "e_1"


def test_stray_field_is_null_for_other_types_in_both_parses(spark):
    p = event("click", "e_1", revenue=99.0, quantity=3)
    raw = to_raw(records(spark, [p]))
    for parse in (parse_three_way, parse_single_pass):
        r = parse(raw).first()
        assert r.revenue is None and r.quantity is None and r.placement == "place_1"


def test_two_advertisers_share_clicks_and_revenue(spark):
    ps = [
        event("impression", "i1", advertiser="adv_a"),
        event("impression", "i2", advertiser="adv_b"),
        event("click", "c1"),
        event("conversion", "v1", revenue=5.0),
    ]
    typed = _typed(spark, ps)
    for build in (campaign_metrics, campaign_metrics_single_pass):
        got = rows(build(typed), "advertiser_id", "impressions", "clicks", "conversions", "revenue")
        assert got == [("adv_a", 1, 1, 1, 5.0), ("adv_b", 1, 1, 1, 5.0)]


def test_advertiser_conflicts_flag_double_counted_keys(spark):
    from campaignlake.operators import advertiser_conflicts

    ps = [
        event("impression", "i1", advertiser="adv_a"),
        event("impression", "i2", advertiser="adv_b"),
        event("impression", "i3", campaign="camp_2"),
    ]
    got = rows(advertiser_conflicts(_typed(spark, ps)), "campaign_id", "advertisers", "impressions")
    assert got == [("camp_1", 2, 2)]


def test_clicks_without_impressions_are_dropped_and_reported(spark):
    ps = [event("impression", "i1", campaign="camp_1"), event("click", "c1", campaign="camp_2")]
    typed = _typed(spark, ps)
    assert rows(campaign_metrics(typed), "campaign_id") == [("camp_1",)]
    assert rows(unmatched_activity(typed), "campaign_id", "clicks") == [("camp_2", 1)]


def test_conversion_without_clicks(spark):
    ps = [event("impression", "i1"), event("conversion", "v1", revenue=7.25, quantity=3)]
    m = campaign_metrics(_typed(spark, ps)).first()
    assert (m.clicks, m.conversions, m.cvr, m.spend, m.roas, m.items_sold) == (0, 1, 1.0, 0.0, 7.25, 3)


def test_viewable_null_counts_as_zero(spark):
    ps = [event("impression", "i1", viewable=None), event("impression", "i2", viewable=True)]
    m = campaign_metrics(_typed(spark, ps)).first()
    assert (m.impressions, m.viewable_impressions) == (2, 1)


def test_null_campaign_forms_own_group_without_clicks(spark):
    ps = [event("impression", "i1", campaign=None), event("click", "c1", campaign=None)]
    for build in (campaign_metrics, campaign_metrics_single_pass):
        m = build(_typed(spark, ps)).collect()
        assert [(r.campaign_id, r.impressions, r.clicks) for r in m] == [(None, 1, 0)]


def test_kpi_formulas_and_half_up_rounding(spark):
    ps = [event("impression", f"i{i}") for i in range(3)] + [
        event("click", "c1"),
        event("click", "c2"),
        event("conversion", "v1", revenue=1.005, quantity=2),
    ]
    m = campaign_metrics(_typed(spark, ps)).first()
    assert m.ctr == round(2 / 3, 4) == 0.6667
    assert m.cvr == 0.5 and m.spend == 1.0
    assert m.revenue == 1.005  # no value is cut to the cent
    assert m.roas == 1.01


def test_duplicates_in_one_batch_keep_first_copy(spark):
    p = event("click", "e_1")
    raw = to_raw(records(spark, [p, p, p], start_offset=5))
    t = typed_events(raw)
    assert t.count() == 1
    # the survivor is the lowest offset: visible through the lineage before dedup
    from campaignlake.operators.dedup import dedup_events
    from campaignlake.operators.typed import parse_typed

    survivor = dedup_events(parse_typed(raw, carry=["eh_partition", "eh_offset"])).first()
    assert survivor.eh_offset == 5


def test_ordered_metrics_are_sorted(spark):
    ps = [event("impression", "i1", campaign="camp_b"), event("impression", "i2", campaign="camp_a"),
          event("impression", "i3", campaign="camp_a", ts="2023-12-31T10:00:00+00:00")]
    got = [(r.event_date.isoformat(), r.campaign_id) for r in campaign_metrics(_typed(spark, ps), ordered=True).collect()]
    assert got == sorted(got)


def test_click_after_midnight_counts_on_its_own_day(spark):
    ps = [
        event("impression", "i1", ts="2024-01-01T23:59:00+00:00"),
        event("impression", "i2", ts="2024-01-02T08:00:00+00:00"),
        event("click", "c1", ts="2024-01-02T00:01:00+00:00"),
        event("click", "c2", ts="2024-01-02T09:00:00+00:00"),
    ]
    got = {r.event_date.isoformat(): (r.impressions, r.clicks, r.ctr)
           for r in campaign_metrics(_typed(spark, ps)).collect()}
    assert got == {"2024-01-01": (1, 0, 0.0), "2024-01-02": (1, 2, 2.0)}  # CTR above 1


def test_replays_inflate_kpis_only_without_dedup(spark):
    ps = [event("impression", "i1"), event("click", "c1"), event("conversion", "v1", revenue=3.0)]
    raw = to_raw(records(spark, ps + ps[1:]))  # the click and the conversion are replayed
    as_coded = campaign_metrics(typed_events(raw, dedup=False)).first()
    deduped = campaign_metrics(typed_events(raw)).first()
    assert (as_coded.clicks, as_coded.conversions, as_coded.revenue) == (2, 2, 6.0)
    assert (deduped.clicks, deduped.conversions, deduped.revenue) == (1, 1, 3.0)



def test_duplicated_key_routes_and_parses_the_same(spark):
    p = '{"event_id":"e_1","event_type":"click","event_type":"impression","campaign_id":"c"}'
    raw = to_raw(records(spark, [p])).first()
    typed = _typed(spark, [p]).first()
    assert raw.event_type == typed.event_type == "impression"


def test_money_sums_keep_every_value(spark):
    from campaignlake.functions.kpi import money_sum

    groups = {
        "mills": [0.004] * 100,
        "halves": [19.995] * 1000,
        "large": [2e16, 0.25],
        "nan": [1.0, float("nan")],
        "infinite": [1.0, float("inf")],
        "beyond": [3e30, 1.0],
        "null": [None, 1.5],
    }
    rows = [(k, v) for k, vs in groups.items() for v in vs]
    sums = spark.createDataFrame(rows, "k string, v double").groupBy("k").agg(money_sum("v").alias("s"))
    got = {r["k"]: r["s"] for r in sums.collect()}
    assert got["mills"] == 0.4 and got["halves"] == 19995.0 and got["null"] == 1.5
    assert got["large"] == 20000000000000000.25 and got["beyond"] == 3e30
    assert got["nan"] != got["nan"] and got["infinite"] == float("inf")
    doubles = sums.sparkSession.createDataFrame(rows, "k string, v double").groupBy("k")
    literal = {r["k"]: r["s"] for r in doubles.agg(money_sum("v", double_sums=True).alias("s")).collect()}
    assert abs(literal["mills"] - 0.4) < 1e-9
