"""Funnel links as a stream: clicks find their impression, conversions their click.

Two stream-stream left outer joins over the typed table, on the referenced id and a
time range: a parent counts for ``window`` after its own event time. Both sides have a
watermark of ``delay``, so state holds the last ``window`` and ``delay`` of events only,
and a child without a parent comes out once none can follow. ``linkage`` reports per
campaign over a whole typed table: links that the stream found stand, and children that
it calls unlinked, still holds in its state or dropped as late are looked up in the
table. So the report equals a batch join on the same time range whatever came late, and
the look-up reads no child that is linked already.

Hot keys: references that more than ``hot_children`` children of the typed table share
are listed when a drain starts. Their children join in one of ``salts`` slots drawn by
their own ids, and such a parent is in all slots, so its children are spread over as many
state partitions; all others have one slot and are stored once. A link that is missed as
its reference became hot between two drains is looked up like those of late rows. Rows
without a reference or a time can't have a parent and stay out of the joins.

Defined results: a child's time may equal its parent's; null references, null times and
references to another type are unlinked; an empty table gives an empty report.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from campaignlake.schemas import TYPED_COLUMNS, TYPED_SCHEMA
from campaignlake.sinks.tables import start_stream
from campaignlake.sources.tables import read_table, read_table_stream
from campaignlake.streaming.layers import LayerPaths, exact_state

WINDOW = "1 day"
DELAY = "2 hours"
SALTS = 4
HOT_CHILDREN = 10_000
HOT_SCHEMA = "hot_ref string, child_type string"
LINK_SCHEMA = "event_id string, event_type string, campaign_id string, event_timestamp timestamp, linked boolean"
_LINK = ["event_id", "event_type", "campaign_id", "event_timestamp"]
_STEPS = {"click": ("impression_id", "impression"), "conversion": ("click_id", "click")}


def links_path(paths: LayerPaths) -> str:
    return f"{paths.typed}_links"


def _children(typed: DataFrame, child: str) -> DataFrame:
    ref = F.col(_STEPS[child][0]).alias("ref")
    return typed.where(F.col("event_type") == child).select(*_LINK, ref)


def _parents(typed: DataFrame, child: str) -> DataFrame:
    rows = typed.where((F.col("event_type") == _STEPS[child][1]) & F.col("event_timestamp").isNotNull())
    return rows.select(F.col("event_id").alias("parent_id"), F.col("event_timestamp").alias("parent_time"))


def _has_parent():
    return F.col("ref").isNotNull() & F.col("event_timestamp").isNotNull()


def _hot_path(paths: LayerPaths) -> str:
    return f"{links_path(paths)}_hot"


def list_hot_references(spark: SparkSession, paths: LayerPaths, hot_children: int = HOT_CHILDREN) -> None:
    """Write the references that more than ``hot_children`` children share."""
    typed = read_table(spark, paths.typed, TYPED_COLUMNS, fmt=paths.fmt, schema=TYPED_SCHEMA)
    refs = None
    for child in _STEPS:
        rows = _children(typed, child).where(_has_parent())
        many = rows.groupBy(F.col("ref").alias("hot_ref")).count().where(F.col("count") > hot_children)
        part = many.select("hot_ref", F.lit(child).alias("child_type"))
        refs = part if refs is None else refs.unionByName(part)
    refs.write.mode("overwrite").parquet(_hot_path(paths))


def _in_range(window: str):
    return F.expr(
        "ref = parent_id AND event_timestamp >= parent_time"
        f" AND event_timestamp <= parent_time + INTERVAL {window}"
    )


def link_stream(
    spark: SparkSession,
    paths: LayerPaths,
    window: str = WINDOW,
    delay: str = DELAY,
    salts: int = SALTS,
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """(event_id, event_type, campaign_id, event_timestamp, linked) of clicks and conversions.

    :func:`list_hot_references` comes first."""
    typed = read_table_stream(
        spark, paths.typed, TYPED_SCHEMA, TYPED_COLUMNS, fmt=paths.fmt, max_files_per_trigger=max_files_per_trigger
    )
    hot = read_table(spark, _hot_path(paths), schema=HOT_SCHEMA)
    listed = F.col("hot_ref").isNotNull()
    slot = F.when(listed, F.pmod(F.xxhash64("event_id"), F.lit(salts)).cast("int")).otherwise(0).alias("slot")
    slots = F.explode(F.sequence(F.lit(0), F.when(listed, salts - 1).otherwise(0))).alias("parent_slot")
    found = None
    for child in _STEPS:
        rows = _children(typed, child)
        many = F.broadcast(hot.where(F.col("child_type") == child).select("hot_ref"))
        asking = rows.where(_has_parent()).join(many, F.col("ref") == F.col("hot_ref"), "left")
        asking = asking.select(*_LINK, "ref", slot).withWatermark("event_timestamp", delay)
        parents = _parents(typed, child).join(many, F.col("parent_id") == F.col("hot_ref"), "left")
        parents = parents.select("parent_id", "parent_time", slots).withWatermark("parent_time", delay)
        joined = asking.join(parents, _in_range(window) & F.expr("slot = parent_slot"), "left_outer")
        joined = joined.select(*_LINK, F.col("parent_id").isNotNull().alias("linked"))
        alone = rows.where(~_has_parent()).select(*_LINK, F.lit(False).alias("linked"))
        part = joined.unionByName(alone)
        found = part if found is None else found.unionByName(part)
    return found


def start_links(
    spark: SparkSession,
    paths: LayerPaths,
    window: str = WINDOW,
    delay: str = DELAY,
    salts: int = SALTS,
    max_files_per_trigger: int | None = None,
    state_partitions: int | None = None,
    hot_children: int = HOT_CHILDREN,
) -> StreamingQuery:
    """Drain the typed table's new rows into the link table."""
    list_hot_references(spark, paths, hot_children)
    df = link_stream(spark, paths, window, delay, salts, max_files_per_trigger)
    with exact_state(spark, state_partitions):
        return start_stream(
            df, links_path(paths), f"{paths.typed_checkpoint}_links", partition_by=["event_type"], fmt=paths.fmt
        )


def linkage(typed: DataFrame, links: DataFrame, window: str = WINDOW) -> DataFrame:
    """Per campaign: clicks and conversions, and how many of them have a parent in range."""
    known = links.where("linked").select(F.col("event_id").alias("known_id"), F.col("event_type").alias("known_type"))
    parts = []
    for child in _STEPS:
        rows = _children(typed, child)
        total = rows.groupBy("campaign_id").agg(F.count("*").alias(f"{child}s"))
        stands = known.where(F.col("known_type") == child).select("known_id")
        same = F.col("event_id") == F.col("known_id")
        streamed = rows.join(stands, same, "left_semi")
        asked = rows.where(_has_parent()).join(stands, same, "left_anti")
        later = asked.join(_parents(typed, child), _in_range(window), "left_semi")
        linked = streamed.select("campaign_id").unionByName(later.select("campaign_id"))
        parts += [total, linked.groupBy("campaign_id").agg(F.count("*").alias(f"linked_{child}s"))]
    stacked = parts[0]
    for part in parts[1:]:
        stacked = stacked.unionByName(part, allowMissingColumns=True)
    names = ["clicks", "linked_clicks", "conversions", "linked_conversions"]
    return stacked.groupBy("campaign_id").agg(*(F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in names))


def dropped_rows(progress: list[dict]) -> int:
    """Rows that the joins dropped as later than the watermark, by a drain's progress.

    Rows of a stateful join, so a parent counts once for each salt.
    """
    return sum(s.get("numRowsDroppedByWatermark", 0) for p in progress for s in p.get("stateOperators", []))
