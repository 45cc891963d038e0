"""Property tests: replaying records never changes the typed table or the
metrics; the two parse plans agree on arbitrary payload shapes."""

from __future__ import annotations

from helpers import event, records
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from campaignlake.operators import (
    campaign_metrics,
    campaign_metrics_single_pass,
    parse_single_pass,
    parse_three_way,
    to_raw,
    typed_events,
)

_TYPES = st.sampled_from(["impression", "click", "conversion", "signup"])
_EVENT = st.tuples(_TYPES, st.integers(0, 5), st.integers(0, 2), st.integers(0, 3), st.booleans())
_SETTINGS = settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))


def _payloads(spec):
    out = []
    for i, (t, camp, adv, day, stray) in enumerate(spec):
        extra = {"revenue": 1.25 * i, "quantity": i} if stray or t == "conversion" else {}
        out.append(event(t, f"e_{i}", ts=f"2024-01-0{day + 1}T10:00:00+00:00", campaign=f"camp_{camp}",
                         advertiser=f"adv_{adv}", **extra))
    return out


def _same(a, b):
    a, b = a.drop("ingested_at"), b.drop("ingested_at")
    assert a.count() == b.count() and a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


@_SETTINGS
@given(spec=st.lists(_EVENT, min_size=1, max_size=12), replays=st.lists(st.integers(0, 11), max_size=8))
def test_replays_do_not_change_typed_or_metrics(spark, spec, replays):
    payloads = _payloads(spec)
    once = to_raw(records(spark, payloads))
    again = [payloads[r % len(payloads)] for r in replays]
    replayed = once.unionByName(to_raw(records(spark, again, start_offset=1000)))
    _same(typed_events(once), typed_events(replayed))
    cols = ["event_date", "campaign_id", "advertiser_id", "impressions", "clicks", "conversions", "revenue", "roas"]
    _same(campaign_metrics(typed_events(once)).select(cols), campaign_metrics(typed_events(replayed)).select(cols))
    _same(campaign_metrics(typed_events(once)).select(cols),
          campaign_metrics_single_pass(typed_events(replayed)).select(cols))


@_SETTINGS
@given(spec=st.lists(_EVENT, min_size=1, max_size=12))
def test_parse_plans_agree(spark, spec):
    raw = to_raw(records(spark, _payloads(spec) + ["{bad", '{"event_type": "click"}']))
    _same(parse_three_way(raw), parse_single_pass(raw))
