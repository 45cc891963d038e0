"""Registered queries: one per operator of the inventory, each a function
``(spark, sf_dir) -> DataFrame`` over the dataset's whole tables.

Outputs leave out the two clock columns (``ingested_at``, ``updated_at``)
and carry timestamps as ``timestamp_ntz`` (UTC wall clock), so they can be
compared value for value with an independent SQL engine.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from campaignlake.operators import funnel as fn
from campaignlake.operators.attribution import attribution_by_campaign
from campaignlake.operators.freshness import freshness, layer_freshness
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
from campaignlake.operators.typed import parse_event, parse_single_pass, parse_three_way, typed_events
from campaignlake.plans.lake import Lake, input_bytes
from campaignlake.schemas import (
    METRICS_COLUMNS,
    METRICS_SCHEMA,
    RAW_COLUMNS,
    RAW_SCHEMA,
    TYPED_COLUMNS,
    TYPED_SCHEMA,
)
from campaignlake.sources.fixtures import kafka_records
from campaignlake.sources.tables import read_table
from campaignlake.streaming.deltas import compact, drain_deltas, retract, write_metrics
from campaignlake.streaming.layers import (
    LayerPaths,
    await_query,
    build_metrics,
    run_layers,
    start_raw_stream,
    start_typed_stream,
)
from campaignlake.streaming.links import LINK_SCHEMA, linkage, links_path, start_links
from campaignlake.streaming.progress import progress_frame
from campaignlake.streaming.replays import start_typed_lookup_stream

Query = Callable[[SparkSession, str], DataFrame]

# Fixed value: the clock the freshness report is evaluated against.
FRESHNESS_AS_OF = "2024-01-31 00:00:00"
STREAM_TIMEOUT_SECONDS = 1800
# The stream queries replay a whole dataset (a backfill spanning every day): the
# raw write is salted, so that a (day, type) directory of an even share of the
# topic gets files of about this size, and state partitions hold as much input.
BACKFILL_TASK_BYTES = 256 << 20
BACKFILL_DIRECTORIES = 100


def _ntz(df: DataFrame, *cols: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in cols if c in df.columns})


def raw_out(df: DataFrame) -> DataFrame:
    cols = [c for c in df.columns if c != "ingested_at"]
    return _ntz(df.select(*cols), "eh_enqueued_time")


def typed_out(df: DataFrame) -> DataFrame:
    cols = [c for c in df.columns if c != "ingested_at"]
    return _ntz(df.select(*cols), "event_timestamp")


def metrics_out(df: DataFrame) -> DataFrame:
    return df.select(*[c for c in df.columns if c != "updated_at"])


# -- sources / raw layer ----------------------------------------------------
def q_encoded_events(spark, sf_dir):
    rec = kafka_records(Lake(spark, sf_dir).events())
    return rec.select(
        F.col("key").cast("string").alias("event_key"),
        F.col("value").cast("string").alias("payload"),
        "topic",
        "partition",
        "offset",
        F.col("timestamp").cast("timestamp_ntz").alias("timestamp"),
        "timestampType",
    )


def q_raw_projection(spark, sf_dir):
    return raw_out(to_raw(Lake(spark, sf_dir).topic()))


def q_raw_profile(spark, sf_dir):
    return raw_profile(Lake(spark, sf_dir).raw(), ordered=True)


def q_raw_sample(spark, sf_dir):
    return raw_out(raw_sample(Lake(spark, sf_dir).raw()))


# -- typed layer --------------------------------------------------------------
def _typed_one(event_type: str) -> Query:
    def q(spark, sf_dir):
        return typed_out(parse_event(Lake(spark, sf_dir).raw(), event_type))

    q.__name__ = f"q_typed_{event_type}s"
    return q


def q_typed_union(spark, sf_dir):
    return typed_out(parse_three_way(Lake(spark, sf_dir).raw()))


def q_typed_union_single_pass(spark, sf_dir):
    return typed_out(parse_single_pass(Lake(spark, sf_dir).raw()))


def q_typed_dedup(spark, sf_dir):
    return typed_out(typed_events(Lake(spark, sf_dir).raw(), single_pass=False))


def q_typed_dedup_single_pass(spark, sf_dir):
    return typed_out(typed_events(Lake(spark, sf_dir).raw(), single_pass=True))


def q_typed_profile(spark, sf_dir):
    return typed_profile(Lake(spark, sf_dir).typed())


def q_typed_conversion_sample(spark, sf_dir):
    return typed_out(typed_sample(Lake(spark, sf_dir).typed(), "conversion", 10))


def q_type_counts(spark, sf_dir):
    return type_counts(Lake(spark, sf_dir).typed())


def q_quarantine(spark, sf_dir):
    return _ntz(quarantine(Lake(spark, sf_dir).raw()), "eh_enqueued_time")


def q_layer_counts(spark, sf_dir):
    lake = Lake(spark, sf_dir)
    raw = lake.raw()
    return layer_counts(raw, lake.typed())


# -- metrics layer --------------------------------------------------------------
def q_impressions_by_campaign(spark, sf_dir):
    return aggregate_impressions(Lake(spark, sf_dir).typed())


def q_clicks_by_campaign(spark, sf_dir):
    return aggregate_clicks(Lake(spark, sf_dir).typed())


def q_conversions_by_campaign(spark, sf_dir):
    return aggregate_conversions(Lake(spark, sf_dir).typed())


def q_campaign_metrics(spark, sf_dir):
    return metrics_out(campaign_metrics(Lake(spark, sf_dir).typed(), ordered=True))


def q_campaign_metrics_exact(spark, sf_dir):
    return metrics_out(campaign_metrics(Lake(spark, sf_dir).typed(), exact=True))


def q_campaign_metrics_single_pass(spark, sf_dir):
    return metrics_out(campaign_metrics_single_pass(Lake(spark, sf_dir).typed()))


def q_campaign_roas_ranking(spark, sf_dir):
    return metrics_out(roas_ranking(campaign_metrics(Lake(spark, sf_dir).typed())))


def q_campaign_roas_top10(spark, sf_dir):
    return metrics_out(roas_ranking(campaign_metrics(Lake(spark, sf_dir).typed()), top=10))


def q_unmatched_activity(spark, sf_dir):
    return unmatched_activity(Lake(spark, sf_dir).typed())


# -- funnel / data-quality reports -------------------------------------------------
def q_pseudonymized_users(spark, sf_dir):
    return fn.pseudonymized_users(Lake(spark, sf_dir).events())


def q_user_activity(spark, sf_dir):
    return fn.user_activity(Lake(spark, sf_dir).typed())


def q_viewability_check(spark, sf_dir):
    return fn.viewability_check(Lake(spark, sf_dir).typed())


def q_line_revenue(spark, sf_dir):
    return fn.line_revenue(Lake(spark, sf_dir).typed())


def q_attribution_credit(spark, sf_dir):
    return attribution_by_campaign(Lake(spark, sf_dir).typed())


def q_funnel_linkage(spark, sf_dir):
    return fn.funnel_linkage(Lake(spark, sf_dir).typed())


def q_funnel_orphans(spark, sf_dir):
    return fn.funnel_orphans(Lake(spark, sf_dir).typed())


def q_funnel_rates(spark, sf_dir):
    return fn.funnel_rates(Lake(spark, sf_dir).typed())


def q_campaign_lookup(spark, sf_dir):
    return fn.campaign_dimension(Lake(spark, sf_dir).typed())


def q_advertiser_conflicts(spark, sf_dir):
    return fn.advertiser_conflicts(Lake(spark, sf_dir).typed())


def q_campaign_metrics_enriched(spark, sf_dir):
    typed = Lake(spark, sf_dir).typed()
    metrics = metrics_out(campaign_metrics(typed))
    return fn.with_campaign_dimension(metrics, fn.campaign_dimension(typed))


def q_freshness(spark, sf_dir):
    as_of = F.lit(FRESHNESS_AS_OF).cast("timestamp")
    out = freshness(Lake(spark, sf_dir).raw(), as_of=as_of).drop("max_ingest_delay_seconds")
    return _ntz(out, "last_enqueued")


def q_layer_freshness(spark, sf_dir):
    lake = Lake(spark, sf_dir)
    typed = lake.typed()
    as_of = F.lit(FRESHNESS_AS_OF).cast("timestamp")
    out = layer_freshness(lake.raw(), typed, campaign_metrics(typed), as_of=as_of)
    return _ntz(out.drop("newest_write"), "newest_event")


# -- streaming chain ----------------------------------------------------------------
def _pieces(spark, paths) -> int:
    return -(-input_bytes(spark, paths.source) // BACKFILL_TASK_BYTES)


def _salts(spark, paths) -> int:
    return max(2, -(-_pieces(spark, paths) // BACKFILL_DIRECTORIES))


def _states(spark, paths) -> int:
    # dedup state partitions for a backfill: by the data, at least one per core
    return max(spark.sparkContext.defaultParallelism, _pieces(spark, paths))


def _stream_paths(spark, sf_dir) -> LayerPaths:
    lake = Lake(spark, sf_dir)
    lake.topic()
    return LayerPaths.under(lake.scratch("stream"), source=lake.topic_path)


def q_stream_raw(spark, sf_dir):
    paths = _stream_paths(spark, sf_dir)
    await_query(start_raw_stream(spark, paths, salt_buckets=_salts(spark, paths)), STREAM_TIMEOUT_SECONDS)
    return raw_out(read_table(spark, paths.raw, RAW_COLUMNS, schema=RAW_SCHEMA))


def q_stream_typed(spark, sf_dir):
    paths = _stream_paths(spark, sf_dir)
    await_query(start_raw_stream(spark, paths, salt_buckets=_salts(spark, paths)), STREAM_TIMEOUT_SECONDS)
    await_query(start_typed_stream(spark, paths, state_partitions=_states(spark, paths)), STREAM_TIMEOUT_SECONDS)
    return typed_out(read_table(spark, paths.typed, TYPED_COLUMNS, schema=TYPED_SCHEMA))


def q_stream_metrics(spark, sf_dir):
    paths = _stream_paths(spark, sf_dir)
    await_query(start_raw_stream(spark, paths, salt_buckets=_salts(spark, paths)), STREAM_TIMEOUT_SECONDS)
    await_query(start_typed_stream(spark, paths, state_partitions=_states(spark, paths)), STREAM_TIMEOUT_SECONDS)
    build_metrics(spark, paths)
    return metrics_out(read_table(spark, paths.metrics, METRICS_COLUMNS, schema=METRICS_SCHEMA))


def q_stream_metrics_incremental(spark, sf_dir):
    paths = _stream_paths(spark, sf_dir)
    run_layers(spark, paths, timeout_seconds=STREAM_TIMEOUT_SECONDS, salt_buckets=_salts(spark, paths),
               incremental_metrics=True, state_partitions=_states(spark, paths))
    return metrics_out(read_table(spark, paths.metrics, METRICS_COLUMNS, schema=METRICS_SCHEMA))


def q_stream_metrics_deltas(spark, sf_dir):
    """The two drains of ``stream_metrics_two_drains``, metrics kept by signed deltas,
    with a compaction between, and a campaign's retraction that an empty one replaces."""
    paths, parts = _two_drains(spark, sf_dir)
    for k, part in enumerate(parts):
        part.write.mode("append").parquet(paths.source)
        await_query(start_raw_stream(spark, paths, salt_buckets=_salts(spark, paths)), STREAM_TIMEOUT_SECONDS)
        await_query(start_typed_stream(spark, paths, state_partitions=_states(spark, paths)), STREAM_TIMEOUT_SECONDS)
        drain_deltas(spark, paths, STREAM_TIMEOUT_SECONDS)
        if k == 0:
            compact(spark, paths)
    typed = read_table(spark, paths.typed, TYPED_COLUMNS, schema=TYPED_SCHEMA)
    retract(typed.where("campaign_id = 'camp_1'"), paths, "camp_1")
    retract(typed.where("false"), paths, "camp_1")
    write_metrics(spark, paths)
    return metrics_out(read_table(spark, paths.metrics, METRICS_COLUMNS, schema=METRICS_SCHEMA))


def _two_drains(spark, sf_dir):
    """The topic arrives in two parts. In the first are the records before the middle
    of its time span, without those of partition 0 (which is late) and second copies;
    all others come with the second."""
    lake = Lake(spark, sf_dir)
    records = lake.topic()
    root = lake.scratch("stream")
    paths = LayerPaths.under(root, source=f"{root}/topic")
    span = records.agg(
        F.min(F.unix_micros("timestamp")).alias("lo"), F.max(F.unix_micros("timestamp")).alias("hi")
    ).first()
    middle = ((span["lo"] or 0) + (span["hi"] or 0)) // 2
    early = F.coalesce(
        (F.unix_micros("timestamp") < middle) & (F.col("partition") != 0) & (F.col("offset") % 2 == 0), F.lit(False)
    )
    return paths, [records.where(early), records.where(~early)]


def q_stream_metrics_two_drains(spark, sf_dir):
    """The second of two drains refreshes only the days it touches."""
    paths, parts = _two_drains(spark, sf_dir)
    for part in parts:
        part.write.mode("append").parquet(paths.source)
        run_layers(spark, paths, timeout_seconds=STREAM_TIMEOUT_SECONDS, salt_buckets=_salts(spark, paths),
                   incremental_metrics=True, state_partitions=_states(spark, paths))
    return metrics_out(read_table(spark, paths.metrics, METRICS_COLUMNS, schema=METRICS_SCHEMA))


def q_stream_linkage(spark, sf_dir):
    """Funnel links by stream-stream joins in two drains, the first without the late rows."""
    paths, parts = _two_drains(spark, sf_dir)
    for part in parts:
        part.write.mode("append").parquet(paths.source)
        states = _states(spark, paths)
        await_query(start_raw_stream(spark, paths, salt_buckets=_salts(spark, paths)), STREAM_TIMEOUT_SECONDS)
        await_query(start_typed_stream(spark, paths, state_partitions=states), STREAM_TIMEOUT_SECONDS)
        await_query(start_links(spark, paths, state_partitions=states), STREAM_TIMEOUT_SECONDS)
    typed = read_table(spark, paths.typed, TYPED_COLUMNS, schema=TYPED_SCHEMA)
    return linkage(typed, read_table(spark, links_path(paths), schema=LINK_SCHEMA))


def q_stream_typed_replays(spark, sf_dir):
    """The topic in two drains, then all records of the first once more; no dedup state."""
    paths, parts = _two_drains(spark, sf_dir)
    for part in [*parts, parts[0]]:
        part.write.mode("append").parquet(paths.source)
        await_query(start_raw_stream(spark, paths, salt_buckets=_salts(spark, paths)), STREAM_TIMEOUT_SECONDS)
        await_query(start_typed_lookup_stream(spark, paths), STREAM_TIMEOUT_SECONDS)
    return typed_out(read_table(spark, paths.typed, TYPED_COLUMNS, schema=TYPED_SCHEMA))


def q_stream_progress(spark, sf_dir):
    paths = _stream_paths(spark, sf_dir)
    raw_q = start_raw_stream(spark, paths, max_files_per_trigger=4, salt_buckets=_salts(spark, paths))
    progress = {"raw": await_query(raw_q, STREAM_TIMEOUT_SECONDS)}
    progress["typed"] = await_query(start_typed_stream(spark, paths, state_partitions=_states(spark, paths)), STREAM_TIMEOUT_SECONDS)
    # batches depend on files and cores, their rows don't
    return progress_frame(spark, progress).groupBy("layer").agg(F.sum("num_input_rows").alias("num_input_rows"))


QUERIES: dict[str, Query] = {
    "encoded_events": q_encoded_events,
    "raw_projection": q_raw_projection,
    "raw_profile": q_raw_profile,
    "raw_sample": q_raw_sample,
    "typed_impressions": _typed_one("impression"),
    "typed_clicks": _typed_one("click"),
    "typed_conversions": _typed_one("conversion"),
    "typed_union": q_typed_union,
    "typed_union_single_pass": q_typed_union_single_pass,
    "typed_dedup": q_typed_dedup,
    "typed_dedup_single_pass": q_typed_dedup_single_pass,
    "typed_profile": q_typed_profile,
    "typed_conversion_sample": q_typed_conversion_sample,
    "type_counts": q_type_counts,
    "quarantine": q_quarantine,
    "layer_counts": q_layer_counts,
    "impressions_by_campaign": q_impressions_by_campaign,
    "clicks_by_campaign": q_clicks_by_campaign,
    "conversions_by_campaign": q_conversions_by_campaign,
    "campaign_metrics": q_campaign_metrics,
    "campaign_metrics_exact": q_campaign_metrics_exact,
    "campaign_metrics_single_pass": q_campaign_metrics_single_pass,
    "campaign_roas_ranking": q_campaign_roas_ranking,
    "campaign_roas_top10": q_campaign_roas_top10,
    "unmatched_activity": q_unmatched_activity,
    "pseudonymized_users": q_pseudonymized_users,
    "user_activity": q_user_activity,
    "viewability_check": q_viewability_check,
    "line_revenue": q_line_revenue,
    "attribution_credit": q_attribution_credit,
    "funnel_linkage": q_funnel_linkage,
    "funnel_orphans": q_funnel_orphans,
    "funnel_rates": q_funnel_rates,
    "campaign_lookup": q_campaign_lookup,
    "campaign_metrics_enriched": q_campaign_metrics_enriched,
    "advertiser_conflicts": q_advertiser_conflicts,
    "freshness": q_freshness,
    "layer_freshness": q_layer_freshness,
    "stream_raw": q_stream_raw,
    "stream_typed": q_stream_typed,
    "stream_typed_replays": q_stream_typed_replays,
    "stream_metrics": q_stream_metrics,
    "stream_metrics_incremental": q_stream_metrics_incremental,
    "stream_metrics_deltas": q_stream_metrics_deltas,
    "stream_linkage": q_stream_linkage,
    "stream_metrics_two_drains": q_stream_metrics_two_drains,
    "stream_progress": q_stream_progress,
}
