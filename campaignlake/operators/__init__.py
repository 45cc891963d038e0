"""DataFrame -> DataFrame operators of the three layers and their reports."""

from campaignlake.operators.attribution import attribution_by_campaign, attribution_credits, touch_paths
from campaignlake.operators.carry import last_prior_values
from campaignlake.operators.dedup import dedup_events, dedup_stream
from campaignlake.operators.freshness import freshness, layer_freshness
from campaignlake.operators.funnel import (
    advertiser_conflicts,
    campaign_dimension,
    funnel_linkage,
    funnel_orphans,
    funnel_rates,
    line_revenue,
    pseudonymized_users,
    user_activity,
    viewability_check,
    with_campaign_dimension,
)
from campaignlake.operators.metrics import (
    aggregate_clicks,
    aggregate_conversions,
    aggregate_impressions,
    campaign_metrics,
    campaign_metrics_single_pass,
    unmatched_activity,
)
from campaignlake.operators.profile import layer_counts, raw_profile, type_counts, typed_profile
from campaignlake.operators.quarantine import quarantine
from campaignlake.operators.raw import to_raw
from campaignlake.operators.samples import raw_sample, roas_ranking, typed_sample
from campaignlake.operators.typed import (
    parse_event,
    parse_single_pass,
    parse_three_way,
    parse_typed,
    typed_events,
)

__all__ = [
    "attribution_by_campaign",
    "attribution_credits",
    "touch_paths",
    "advertiser_conflicts",
    "aggregate_clicks",
    "aggregate_conversions",
    "aggregate_impressions",
    "campaign_dimension",
    "campaign_metrics",
    "campaign_metrics_single_pass",
    "dedup_events",
    "dedup_stream",
    "freshness",
    "funnel_linkage",
    "funnel_orphans",
    "funnel_rates",
    "last_prior_values",
    "layer_counts",
    "layer_freshness",
    "line_revenue",
    "parse_event",
    "parse_single_pass",
    "parse_three_way",
    "parse_typed",
    "pseudonymized_users",
    "quarantine",
    "raw_profile",
    "raw_sample",
    "roas_ranking",
    "to_raw",
    "type_counts",
    "typed_events",
    "typed_profile",
    "typed_sample",
    "unmatched_activity",
    "user_activity",
    "viewability_check",
    "with_campaign_dimension",
]
