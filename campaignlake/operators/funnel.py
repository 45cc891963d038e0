"""Funnel reports over the typed table (impression -> click -> conversion).

These go a step past the metrics layer: they follow the id links carried by
clicks (``impression_id``) and conversions (``click_id``).  Links are
resolved after pre-aggregating the referring side by (campaign, referenced
id), so a single id referenced by a huge number of events is one row in the
join, not a hot key.  The orphan report returns rows, so it can't aggregate:
rows without a reference skip its join, and AQE splits a skewed dangling id.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from campaignlake.functions.kpi import MONEY
from campaignlake.functions.privacy import pseudonymize

# The funnel rates the event source is expected to follow.
EXPECTED_CTR = 0.02
EXPECTED_CVR = 0.05


def _revenue_parts(c) -> list:
    # decimal and double sum and the count of values without decimal form, kept
    # across both aggregation steps, so that the total is the one of money_sum
    form = c.try_cast(MONEY)
    exact = F.try_sum(form)
    too_large = (exact.isNull() & (F.count(form) > 0)).cast("long")
    return [
        exact.alias("exact"),
        F.sum(c).alias("doubles"),
        (F.count_if(c.isNotNull() & form.isNull()) + too_large).alias("odd"),
    ]


def _revenue_total(double_sums: bool):
    doubles = F.sum("linked_doubles")
    if double_sums:
        return doubles
    exact = F.try_sum("linked_exact")
    unfit = (F.sum("linked_odd") > 0) | (exact.isNull() & (F.count("linked_exact") > 0))
    return F.when(unfit, doubles).otherwise(exact.cast("double"))


def _ids(typed: DataFrame, event_type: str, as_name: str) -> DataFrame:
    return (
        typed.filter(F.col("event_type") == event_type)
        .select(F.col("event_id").alias(as_name))
        .where(F.col(as_name).isNotNull())
        .distinct()
    )


def funnel_linkage(typed: DataFrame, double_sums: bool = False) -> DataFrame:
    """Per campaign: impressions, clicks and how many link to an existing
    impression, conversions and how many link to an existing click, and the
    revenue of the linked conversions."""
    t = F.col("event_type")
    clicks = (
        typed.filter(t == "click")
        .groupBy("campaign_id", "impression_id")
        .agg(F.count("*").alias("n"))
        .join(_ids(typed, "impression", "impression_id").withColumn("hit", F.lit(True)), "impression_id", "left")
        .select("campaign_id", F.col("n").alias("clicks"),
                F.when(F.col("hit"), F.col("n")).otherwise(0).alias("linked_clicks"))
    )
    conversions = (
        typed.filter(t == "conversion")
        .groupBy("campaign_id", "click_id")
        .agg(F.count("*").alias("n"), *_revenue_parts(F.col("revenue")))
        .join(_ids(typed, "click", "click_id").withColumn("hit", F.lit(True)), "click_id", "left")
        .select("campaign_id", F.col("n").alias("conversions"),
                F.when(F.col("hit"), F.col("n")).otherwise(0).alias("linked_conversions"),
                *(F.when(F.col("hit"), F.col(c)).alias(f"linked_{c}") for c in ("exact", "doubles", "odd")))
    )
    impressions = typed.filter(t == "impression").groupBy("campaign_id").agg(F.count("*").alias("impressions"))
    parts = [impressions, clicks, conversions]
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return stacked.groupBy("campaign_id").agg(
        F.coalesce(F.sum("impressions"), F.lit(0)).alias("impressions"),
        F.coalesce(F.sum("clicks"), F.lit(0)).alias("clicks"),
        F.coalesce(F.sum("linked_clicks"), F.lit(0)).alias("linked_clicks"),
        F.coalesce(F.sum("conversions"), F.lit(0)).alias("conversions"),
        F.coalesce(F.sum("linked_conversions"), F.lit(0)).alias("linked_conversions"),
        F.coalesce(_revenue_total(double_sums), F.lit(0.0)).alias("linked_revenue"),
    )


def funnel_orphans(typed: DataFrame) -> DataFrame:
    """Clicks without an existing impression and conversions without an
    existing click, with the missing reference and why it does not resolve."""
    t = F.col("event_type")

    def orphans(child: str, ref_col: str, parent: str) -> DataFrame:
        rows = typed.filter(t == child).select(
            "event_id", "event_type", "campaign_id",
            F.lit(parent).alias("ref_type"), F.col(ref_col).alias("ref_id"),
        )
        # rows without a reference need no join, so they are never one hot key of it
        missing = rows.where(F.col("ref_id").isNull()).withColumn("reason", F.lit("missing_ref"))
        parents = typed.filter(t == parent).select(F.col("event_id").alias("parent_id"))
        dangling = (
            rows.where(F.col("ref_id").isNotNull())
            .join(parents, F.col("ref_id") == F.col("parent_id"), "left_anti")
            .withColumn("reason", F.lit("dangling_ref"))
        )
        return missing.unionByName(dangling)

    return orphans("click", "impression_id", "impression").unionByName(orphans("conversion", "click_id", "click"))


def funnel_rates(
    typed: DataFrame,
    expected_ctr: float = EXPECTED_CTR,
    expected_cvr: float = EXPECTED_CVR,
) -> DataFrame:
    """Observed click-through and conversion rates per campaign next to the
    expected ones (NULL where the denominator is 0)."""
    t = F.col("event_type")
    agg = typed.groupBy("campaign_id").agg(
        F.count_if(t == "impression").alias("impressions"),
        F.count_if(t == "click").alias("clicks"),
        F.count_if(t == "conversion").alias("conversions"),
    )
    return agg.select(
        "campaign_id",
        "impressions",
        "clicks",
        "conversions",
        F.round(F.try_divide(F.col("clicks"), F.col("impressions")), 4).alias("ctr"),
        F.round(F.try_divide(F.col("conversions"), F.col("clicks")), 4).alias("cvr"),
        F.lit(expected_ctr).alias("expected_ctr"),
        F.lit(expected_cvr).alias("expected_cvr"),
    )


def viewability_check(typed: DataFrame, threshold_seconds: float = 1.0) -> DataFrame:
    """Per campaign: impressions, flagged viewable, viewable by the seconds
    rule (``viewable_seconds >= threshold``), and rows where they disagree."""
    imp = typed.filter(F.col("event_type") == "impression")
    derived = F.col("viewable_seconds") >= F.lit(threshold_seconds)
    return imp.groupBy("campaign_id").agg(
        F.count("*").alias("impressions"),
        F.count_if(F.col("viewable")).alias("viewable_flagged"),
        F.count_if(derived).alias("viewable_by_seconds"),
        F.count_if(~F.col("viewable").eqNullSafe(derived)).alias("mismatches"),
    )


def line_revenue(typed: DataFrame) -> DataFrame:
    """Conversions with unit price, the line revenue recomputed as
    round(unit_price * quantity, 2), and whether it equals the reported one."""
    conv = typed.filter(F.col("event_type") == "conversion")
    unit = F.round(F.try_divide(F.col("revenue"), F.col("quantity")), 2)
    line = F.round(unit * F.col("quantity"), 2)
    return conv.select(
        "event_id",
        "campaign_id",
        "product_id",
        "quantity",
        "revenue",
        unit.alias("unit_price"),
        line.alias("line_revenue"),
        (line == F.round(F.col("revenue"), 2)).alias("revenue_matches"),
    )


def user_activity(typed: DataFrame) -> DataFrame:
    """Events per pseudonymous user and type."""
    t = F.col("event_type")
    return typed.groupBy("user_id_hashed").agg(
        F.count_if(t == "impression").alias("impressions"),
        F.count_if(t == "click").alias("clicks"),
        F.count_if(t == "conversion").alias("conversions"),
    )


def pseudonymized_users(events: DataFrame, id_col: str = "user_id") -> DataFrame:
    """Distinct ids with their SHA-256 pseudonym and event count."""
    return events.groupBy(id_col).agg(F.count("*").alias("events")).select(
        id_col, pseudonymize(id_col).alias("user_id_hashed"), "events"
    )


def campaign_dimension(typed: DataFrame) -> DataFrame:
    """Campaign lookup built from the events: advertiser(s), activity span.

    ``advertisers > 1`` flags a campaign that breaks the campaign ->
    advertiser dependency the metrics join relies on.
    """
    return typed.groupBy("campaign_id").agg(
        F.min("advertiser_id").alias("advertiser_id"),
        F.count_distinct("advertiser_id").alias("advertisers"),
        F.min(F.to_date("event_timestamp")).alias("first_day"),
        F.max(F.to_date("event_timestamp")).alias("last_day"),
        F.count("*").alias("events"),
    )


def with_campaign_dimension(metrics: DataFrame, dimension: DataFrame) -> DataFrame:
    """Metrics rows with their campaign's span and advertiser count.

    A plain left join on ``campaign_id``: the dimension has one row per
    campaign, so Spark broadcasts it when its measured size is under the
    broadcast threshold (AQE re-checks at run time) and sort-merges it
    otherwise; no hint that would force a broadcast of an unbounded table.
    """
    dim = dimension.select(
        "campaign_id",
        F.col("advertisers").alias("campaign_advertisers"),
        F.col("first_day").alias("campaign_first_day"),
        F.col("last_day").alias("campaign_last_day"),
    )
    return metrics.join(dim, "campaign_id", "left")


def advertiser_conflicts(typed: DataFrame) -> DataFrame:
    """(campaign, day) keys whose impressions carry more than one advertiser.

    The metrics join attaches a campaign-day's clicks and conversions to every
    advertiser row of that key, so each row listed here is double counted in
    campaign totals.  Empty when each campaign has one advertiser.
    """
    imp = typed.filter(F.col("event_type") == "impression")
    return (
        imp.groupBy("campaign_id", F.to_date("event_timestamp").alias("event_date"))
        .agg(F.count_distinct("advertiser_id").alias("advertisers"), F.count("*").alias("impressions"))
        .where(F.col("advertisers") > 1)
    )
