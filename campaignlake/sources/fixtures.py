"""Derive Kafka-shaped ad-event records from the generic ``events`` table.

This stands in for the producer: each ``events`` row becomes one JSON event
on the wire, wrapped in the record envelope the Kafka source yields.  The
mapping (which columns feed which event field) is the test-input contract;
click and conversion ids link to the user's previous impression / click.

Everything is a DataFrame expression; the only shuffles are the linkage scan
(see :mod:`campaignlake.operators.carry`) and, where segments are asked for, that
of its narrow rows by time, before they become JSON.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from campaignlake.functions.privacy import pseudonymize
from campaignlake.operators.carry import last_prior_values

# Fixed values of the fixture mapping.
TOPIC = "ad-events"
TOPIC_PARTITIONS = 4
REPLAY_EVERY = 100
HOT_USER_ROWS = 1_000_000
WIRE_TIMESTAMP_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'"
TYPE_MAP = {"view": "impression", "purchase": "conversion", "click": "click"}
DEVICES = ["mobile", "desktop", "tablet"]
CHANNELS = ["app", "web"]
ATTRIBUTION_MODELS = ["last_click", "linear", "time_decay"]


def _pick(values: list[str], index: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))


def _wire_id(eid: Column) -> Column:
    return F.concat(F.lit("e_"), eid.cast("string"))


def _event_type(raw_type: Column) -> Column:
    expr = raw_type
    for src, dst in TYPE_MAP.items():
        expr = F.when(raw_type == src, F.lit(dst)).otherwise(expr) if src != dst else expr
    return expr


def mapped_events(events: DataFrame, link_bucket: str = "minute", segments: int | None = None) -> DataFrame:
    """``events`` rows as typed event fields (one column per wire field).

    ``segments`` deals the rows to that many tasks in the order of their time."""
    k = F.get_json_object("props", "$.k").cast("int")
    base = events.select(
        F.col("event_id").alias("_eid"),
        F.col("user_id").alias("_uid"),
        F.col("ts").alias("_ts"),
        F.col("value").alias("_value"),
        k.alias("_k"),
        _event_type(F.col("event_type")).alias("event_type"),
    )
    linked = last_prior_values(
        base,
        key="_uid",
        order=["_ts", "_eid"],
        values={
            "impression_id": F.when(F.col("event_type") == "impression", F.col("_eid")),
            "click_id": F.when(F.col("event_type") == "click", F.col("_eid")),
        },
        bucket=F.date_trunc(link_bucket, F.col("_ts")),
        hot_rows=HOT_USER_ROWS,
    )
    if segments:
        linked = linked.repartitionByRange(segments, "_ts", "_eid")
    t = F.col("event_type")
    kk = F.col("_k")
    value = F.col("_value")
    return linked.select(
        "_eid",
        "_uid",
        "_ts",
        _wire_id(F.col("_eid")).alias("event_id"),
        t.alias("event_type"),
        F.date_format("_ts", WIRE_TIMESTAMP_FORMAT).alias("event_timestamp"),
        F.concat(F.lit("camp_"), kk.cast("string")).alias("campaign_id"),
        F.concat(F.lit("ad_"), (F.col("_eid") % 50).cast("string")).alias("ad_id"),
        F.concat(F.lit("adv_"), (kk % 20).cast("string")).alias("advertiser_id"),
        F.concat(F.lit("pub_"), (F.col("_uid") % 3).cast("string")).alias("publisher_id"),
        pseudonymize("_uid").alias("user_id_hashed"),
        F.concat(F.lit("s_"), F.col("_uid").cast("string"), F.lit("_"), F.date_format("_ts", "yyyy-MM-dd")).alias(
            "session_id"
        ),
        _pick(DEVICES, F.col("_uid") % 3).alias("device_type"),
        _pick(CHANNELS, F.col("_uid") % 2).alias("channel"),
        F.concat(F.lit("place_"), (F.col("_eid") % 5).cast("string")).alias("placement"),
        (value / 10).alias("viewable_seconds"),
        (value / 10 >= 1.0).alias("viewable"),
        _wire_id(F.col("impression_id")).alias("impression_id"),
        _wire_id(F.col("click_id")).alias("click_id"),
        F.concat(F.lit("ord_"), F.col("_eid").cast("string")).alias("order_id"),
        F.concat(F.lit("prod_"), (kk % 24).cast("string")).alias("product_id"),
        F.concat(F.lit("cat_"), (kk % 8).cast("string")).alias("product_category"),
        value.alias("revenue"),
        (kk % 5 + 1).cast("int").alias("quantity"),
        _pick(ATTRIBUTION_MODELS, kk % 3).alias("attribution_model"),
    )


COMMON_WIRE = [
    "event_id",
    "event_type",
    "event_timestamp",
    "campaign_id",
    "ad_id",
    "advertiser_id",
    "publisher_id",
    "user_id_hashed",
    "session_id",
]
WIRE_FIELDS = {
    "impression": COMMON_WIRE + ["device_type", "channel", "placement", "viewable", "viewable_seconds"],
    "click": COMMON_WIRE + ["device_type", "channel", "placement", "impression_id"],
    "conversion": COMMON_WIRE
    + [
        "click_id",
        "impression_id",
        "order_id",
        "product_id",
        "product_category",
        "revenue",
        "quantity",
        "attribution_model",
    ],
}
FOREIGN_WIRE = COMMON_WIRE + ["device_type", "channel"]

_JSON_OPTS = {"ignoreNullFields": "false"}


def encode_payload(df: DataFrame) -> Column:
    """JSON text of each mapped event, with the fields of its own type."""
    t = F.col("event_type")
    expr = F.to_json(F.struct(*FOREIGN_WIRE), _JSON_OPTS)
    for etype, fields in WIRE_FIELDS.items():
        expr = F.when(t == etype, F.to_json(F.struct(*fields), _JSON_OPTS)).otherwise(expr)
    return expr


def kafka_records(
    events: DataFrame,
    replay_every: int | None = REPLAY_EVERY,
    link_bucket: str = "minute",
    segments: int | None = None,
) -> DataFrame:
    """Kafka-shaped records (``KAFKA_SCHEMA``) for every ``events`` row.

    ``replay_every`` re-sends every n-th event id once more (same key and
    value, the odd offset after it), as an at-least-once producer retry would; those
    copies exist to exercise deduplication.
    """
    mapped = mapped_events(events, link_bucket, segments)
    if replay_every:
        copies = F.when(F.col("_eid") % replay_every == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    else:
        copies = F.array(F.lit(0))
    mapped = mapped.withColumn("_copy", F.explode(copies))
    return mapped.select(
        F.col("event_id").cast("binary").alias("key"),
        encode_payload(mapped).cast("binary").alias("value"),
        F.lit(TOPIC).alias("topic"),
        (F.col("_eid") % TOPIC_PARTITIONS).cast("int").alias("partition"),
        (F.col("_eid") * 2 + F.col("_copy")).cast("long").alias("offset"),
        F.col("_ts").cast("timestamp").alias("timestamp"),
        F.lit(0).alias("timestampType"),
    )
