"""Campaign metrics from signed partial aggregates.

Events are reduced to partial sums per (event type, campaign, day, advertiser), each with
a sign: +1 for events that came, -1 for events taken back (a deletion request, a
cancelled order). Partials add up in any order and grouping, so metrics follow from
the partials of all drains without reading an event twice, also when late events reach
any old day. Money is kept as an exact decimal sum of the values that have that form and
as counts and a double sum of those that don't, so that taking back an odd value leaves
the exact sum of the rest.

Scale: partials are one row per campaign and day a drain touched; merging them is a
partial and a final aggregate over these rows, not over events.

Defined results: the rows of :func:`campaign_metrics` over the events that remain; a
group whose events were all taken back has no row; a NULL campaign or day is a group
of its own that matches no activity; an empty input has no partials.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from campaignlake.functions.kpi import DEFAULT_CPC, MONEY
from campaignlake.functions.payload import event_day
from campaignlake.operators.metrics import finish_metrics

PARTIAL_KEYS = ["event_type", "campaign_id", "event_date", "advertiser_id"]
#: ``large``, ``nans``, ``highs`` and ``lows`` count finite values without decimal form, NaN and infinities.
PARTIAL_SCHEMA = (
    "event_type string, campaign_id string, event_date date, advertiser_id string, events long,"
    " viewable long, items long, exact decimal(38,10), finite double, large long, nans long, highs long, lows long"
)
_SUMS = ["events", "viewable", "items", "finite", "large", "nans", "highs", "lows"]


def signed_partials(typed: DataFrame, sign: int = 1) -> DataFrame:
    """Partial sums (``PARTIAL_SCHEMA``) of typed events, times ``sign``."""
    if sign not in (1, -1):
        raise ValueError(f"sign is {sign}, 1 or -1 is needed")
    of = F.col("event_type")
    value = F.when(of == "conversion", F.col("revenue"))
    form = value.try_cast(MONEY)
    infinite = F.abs(value) == float("inf")
    odd = value.isNotNull() & form.isNull()
    measures = {
        "events": F.count("*"),
        "viewable": F.count_if((of == "impression") & F.col("viewable")),
        "items": F.coalesce(F.sum(F.when(of == "conversion", F.col("quantity"))), F.lit(0)),
        "finite": F.coalesce(F.sum(F.when(~F.isnan(value) & ~infinite, value)), F.lit(0.0)),
        "large": F.count_if(odd & ~F.isnan(value) & ~infinite),
        "nans": F.count_if(F.isnan(value)),
        "highs": F.count_if(value == float("inf")),
        "lows": F.count_if(value == float("-inf")),
    }
    grouped = typed.where(of.isin("impression", "click", "conversion")).groupBy(
        "event_type",
        "campaign_id",
        event_day("event_timestamp").alias("event_date"),
        F.when(of == "impression", F.col("advertiser_id")).alias("advertiser_id"),
    )
    exact = F.try_sum(form)
    rows = grouped.agg(
        *(c.alias(n) for n, c in measures.items()),
        exact.alias("exact"),
        (exact.isNull() & (F.count(form) > 0)).cast("long").alias("unfit"),
    )
    # a sum that doesn't fit is told like a value without decimal form
    rows = rows.withColumn("large", F.col("large") + F.col("unfit"))
    signed = [(F.col(c) * sign).alias(c) for c in _SUMS]
    money = (F.coalesce("exact", F.lit(0)).cast(MONEY) * F.lit(sign)).cast(MONEY).alias("exact")
    return rows.select(*PARTIAL_KEYS, *signed[:3], money, *signed[3:])


def merge_partials(partials: DataFrame) -> DataFrame:
    """One partial per key; keys whose events were all taken back go."""
    exact = F.try_sum("exact")
    merged = partials.groupBy(*PARTIAL_KEYS).agg(
        *(F.sum(c).alias(c) for c in _SUMS),
        F.coalesce(exact, F.lit(0)).cast(MONEY).alias("exact"),
        (exact.isNull() & (F.count("exact") > 0)).cast("long").alias("unfit"),
    )
    merged = merged.withColumn("large", F.col("large") + F.col("unfit")).where("events <> 0")
    return merged.select(*partials.columns)


def _revenue() -> Column:
    mixed = (F.col("nans") > 0) | ((F.col("highs") > 0) & (F.col("lows") > 0))
    return (
        F.when(mixed, float("nan"))
        .when(F.col("highs") > 0, float("inf"))
        .when(F.col("lows") > 0, float("-inf"))
        .when(F.col("large") > 0, F.col("finite"))
        .otherwise(F.col("exact").cast("double"))
    )


def metrics_from_partials(
    partials: DataFrame, cpc: float = DEFAULT_CPC, exact: bool = False, ordered: bool = False
) -> DataFrame:
    """The metrics table of the events that signed partials stand for."""
    merged = merge_partials(partials)
    keys = ["campaign_id", "event_date"]
    rows = merged.where("event_type = 'impression'").select(
        *keys, "advertiser_id", F.col("events").alias("impressions"), F.col("viewable").alias("viewable_impressions")
    )
    clicks = merged.where("event_type = 'click'").select(*keys, F.col("events").alias("clicks"))
    conversions = merged.where("event_type = 'conversion'").select(
        *keys, F.col("events").alias("conversions"), _revenue().alias("revenue"), F.col("items").alias("items_sold")
    )
    for activity in (clicks, conversions):
        rows = rows.join(activity, keys, "left")
    return finish_metrics(rows, cpc, exact, ordered)
