from __future__ import annotations

import datetime as dt
import json

from campaignlake.schemas import KAFKA_SCHEMA

SF_SMALL = "/root/testdata/sf0.001"


def event(event_type, event_id, ts="2024-01-01T10:00:00.000000+00:00", campaign="camp_1",
          advertiser="adv_1", **extra):
    body = {
        "event_id": event_id,
        "event_type": event_type,
        "event_timestamp": ts,
        "campaign_id": campaign,
        "ad_id": "ad_1",
        "advertiser_id": advertiser,
        "publisher_id": "pub_1",
        "user_id_hashed": "u",
        "session_id": "s",
    }
    if event_type != "conversion":
        body.update(device_type="mobile", channel="app")
    if event_type in ("impression", "click"):
        body["placement"] = "place_1"
    if event_type == "impression":
        body.update(viewable=True, viewable_seconds=2.0)
    if event_type == "conversion":
        body.update(click_id=None, impression_id=None, order_id="o", product_id="p",
                    product_category="c", revenue=10.0, quantity=1, attribution_model="linear")
    body.update(extra)
    return json.dumps(body)


def rows(df, *cols):
    """Selected columns of every row, in a stable order (NULLs last)."""
    return sorted((tuple(r[c] for c in cols) for r in df.collect()),
                  key=lambda t: [(v is None, str(v)) for v in t])


def records(spark, payloads, start_offset=0, partition=0, ts=None):
    """Kafka-shaped rows carrying the given payload strings."""
    ts = ts or dt.datetime(2024, 1, 1, 12, 0, 0)
    rows = [
        (None, p.encode() if p is not None else None, "ad-events", partition, start_offset + i, ts, 0)
        for i, p in enumerate(payloads)
    ]
    return spark.createDataFrame(rows, KAFKA_SCHEMA)
