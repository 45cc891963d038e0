"""Schemas and column contracts of the three layers.

Kafka record -> raw table -> typed table -> campaign metrics.  Event JSON is
never schema-inferred: every event type is parsed with its own explicit
StructType, so a field that does not belong to a type (a ``revenue`` inside a
click, say) stays NULL.
"""

from __future__ import annotations

from pyspark.sql.types import (
    BinaryType,
    BooleanType,
    DateType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
    TimestampType,
)

# The closed set of event types and the record envelope.
EVENT_TYPES = ("impression", "click", "conversion")

KAFKA_SCHEMA = StructType(
    [
        StructField("key", BinaryType()),
        StructField("value", BinaryType()),
        StructField("topic", StringType()),
        StructField("partition", IntegerType()),
        StructField("offset", LongType()),
        StructField("timestamp", TimestampType()),
        StructField("timestampType", IntegerType()),
    ]
)

# The event wire schemas, the fields every event carries and
# the fields of each event type, with their types.
COMMON_FIELDS = [
    StructField("event_id", StringType()),
    StructField("event_type", StringType()),
    StructField("event_timestamp", TimestampType()),
    StructField("campaign_id", StringType()),
    StructField("ad_id", StringType()),
    StructField("advertiser_id", StringType()),
    StructField("publisher_id", StringType()),
    StructField("user_id_hashed", StringType()),
    StructField("session_id", StringType()),
    StructField("device_type", StringType()),
    StructField("channel", StringType()),
]

IMPRESSION_SCHEMA = StructType(
    COMMON_FIELDS
    + [
        StructField("placement", StringType()),
        StructField("viewable", BooleanType()),
        StructField("viewable_seconds", DoubleType()),
    ]
)

CLICK_SCHEMA = StructType(
    COMMON_FIELDS
    + [
        StructField("placement", StringType()),
        StructField("impression_id", StringType()),
    ]
)

CONVERSION_SCHEMA = StructType(
    COMMON_FIELDS
    + [
        StructField("click_id", StringType()),
        StructField("impression_id", StringType()),
        StructField("order_id", StringType()),
        StructField("product_id", StringType()),
        StructField("product_category", StringType()),
        StructField("revenue", DoubleType()),
        StructField("quantity", IntegerType()),
        StructField("attribution_model", StringType()),
    ]
)

EVENT_SCHEMAS = {
    "impression": IMPRESSION_SCHEMA,
    "click": CLICK_SCHEMA,
    "conversion": CONVERSION_SCHEMA,
}


def _superset() -> StructType:
    fields: dict[str, StructField] = {}
    for schema in EVENT_SCHEMAS.values():
        for f in schema.fields:
            fields.setdefault(f.name, f)
    return StructType(list(fields.values()))


# One schema holding every field of every type, for the single-pass parse.
SUPERSET_SCHEMA = _superset()

# Which event types own each non-common field (drives type gating, N9).
FIELD_OWNERS: dict[str, tuple[str, ...]] = {
    f.name: tuple(t for t, s in EVENT_SCHEMAS.items() if f.name in s.fieldNames())
    for f in SUPERSET_SCHEMA.fields
}

RAW_COLUMNS = [
    "raw_payload",
    "eh_topic",
    "eh_partition",
    "eh_offset",
    "eh_enqueued_time",
    "event_type",
    "event_timestamp",
    "campaign_id",
    "event_date",
    "ingested_at",
]
RAW_PARTITION_COLUMNS = ["event_date", "event_type"]

# Column order produced by impressions UNION BY NAME clicks UNION BY NAME
# conversions (missing columns appended in order of appearance).
TYPED_COLUMNS = (
    [f.name for f in IMPRESSION_SCHEMA.fields]
    + ["ingested_at", "impression_id"]
    + ["click_id", "order_id", "product_id", "product_category", "revenue", "quantity", "attribution_model"]
)
TYPED_PARTITION_COLUMNS = ["event_type"]

METRICS_COLUMNS = [
    "event_date",
    "campaign_id",
    "advertiser_id",
    "impressions",
    "viewable_impressions",
    "clicks",
    "conversions",
    "revenue",
    "items_sold",
    "ctr",
    "cvr",
    "spend",
    "roas",
    "updated_at",
]
METRICS_PARTITION_COLUMNS = ["event_date"]

# Lineage columns carried through the parse until dedup has chosen a survivor.
LINEAGE_COLUMNS = ["eh_partition", "eh_offset"]


def _typed_schema() -> StructType:
    by_name = {f.name: f for f in SUPERSET_SCHEMA.fields}
    by_name["ingested_at"] = StructField("ingested_at", TimestampType())
    return StructType([by_name[c] for c in TYPED_COLUMNS])


RAW_SCHEMA = StructType(
    [
        StructField("raw_payload", StringType()),
        StructField("eh_topic", StringType()),
        StructField("eh_partition", IntegerType()),
        StructField("eh_offset", LongType()),
        StructField("eh_enqueued_time", TimestampType()),
        StructField("event_type", StringType()),
        StructField("event_timestamp", StringType()),
        StructField("campaign_id", StringType()),
        StructField("event_date", DateType()),
        StructField("ingested_at", TimestampType()),
    ]
)
TYPED_SCHEMA = _typed_schema()
METRICS_SCHEMA = StructType(
    [
        StructField("event_date", DateType()),
        StructField("campaign_id", StringType()),
        StructField("advertiser_id", StringType()),
        StructField("impressions", LongType()),
        StructField("viewable_impressions", LongType()),
        StructField("clicks", LongType()),
        StructField("conversions", LongType()),
        StructField("revenue", DoubleType()),
        StructField("items_sold", LongType()),
        StructField("ctr", DoubleType()),
        StructField("cvr", DoubleType()),
        StructField("spend", DoubleType()),
        StructField("roas", DoubleType()),
        StructField("updated_at", TimestampType()),
    ]
)

# The generic input table the fixture derives topic records from.
EVENTS_SCHEMA = StructType(
    [
        StructField("event_id", LongType()),
        StructField("ts", TimestampNTZType()),
        StructField("user_id", LongType()),
        StructField("event_type", StringType()),
        StructField("value", DoubleType()),
        StructField("props", StringType()),
    ]
)
