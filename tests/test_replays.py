"""Dedup by look-up in the typed table: exact on replays, nothing kept, pruned reads."""

from __future__ import annotations

import datetime as dt
import os

import pytest
from helpers import event, records
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from campaignlake.schemas import LINEAGE_COLUMNS, RAW_COLUMNS, RAW_SCHEMA, TYPED_COLUMNS, TYPED_SCHEMA
from campaignlake.operators.typed import parse_typed
from campaignlake.sources.tables import read_table
from campaignlake.streaming import LayerPaths, await_query, start_raw_stream, start_typed_stream
from campaignlake.streaming.replays import append_unseen, close_gaps, start_typed_lookup_stream, unseen


def _on(day):
    return f"2024-01-{day:02d}T10:00:00.000000+00:00"


def _drain(spark, paths, payloads, offset, **how):
    records(spark, payloads, start_offset=offset).write.mode("append").parquet(paths.source)
    await_query(start_raw_stream(spark, paths), 600)
    await_query(start_typed_lookup_stream(spark, paths, **how), 600)
    return read_table(spark, paths.typed, TYPED_COLUMNS, schema=TYPED_SCHEMA)


@given(st.lists(st.dates(), max_size=30), st.integers(1, 6))
@settings(max_examples=200, deadline=None)
def test_ranges_hold_every_day(days, most):
    found = close_gaps(days, most)
    assert len(found) <= most
    assert all(any(a <= d <= b for a, b in found) for d in days)
    assert {d for r in found for d in r} <= set(days)
    assert all(b < c for (_, b), (c, _) in zip(found, found[1:]))


def test_replays_of_any_age_over_ten_drains(spark, scratch):
    paths = LayerPaths.under(scratch, source=f"{scratch}/source")
    sent, kept = [], []
    for drain in range(10):
        new = [event("click", f"e_{drain}_{k}", ts=_on(1 + drain)) for k in range(3)]
        late = [event("impression", f"late_{drain}", ts=_on(1))]
        payloads = new + late + sent[drain::3] + new[:1] * 20 + ["no json", event("click", None)]
        typed = _drain(spark, paths, payloads, 1000 * drain)
        sent += new + late
        files = [f for _, _, fs in os.walk(paths.typed_checkpoint) for f in fs]
        kept.append(len(files))
        assert not os.path.exists(f"{paths.typed_checkpoint}/state")
    ids = [r["event_id"] for r in typed.select("event_id").collect()]
    assert len(ids) == len(set(ids)) == len(sent) == 40
    # a drain adds its entries of the source, offset and commit logs, with checksums, and no ids
    assert all(b - a <= 6 for a, b in zip(kept, kept[1:]))


def test_a_repeated_batch_adds_nothing(spark, scratch):
    """What a lost attempt wrote, whole or in part, isn't written again."""
    paths = LayerPaths.under(scratch, source=f"{scratch}/source")
    _drain(spark, paths, [event("click", "a"), event("impression", "b", ts=_on(3))], 0)
    raw = read_table(spark, paths.raw, RAW_COLUMNS, schema=RAW_SCHEMA)
    again = parse_typed(raw, carry=LINEAGE_COLUMNS)
    part = again.where("event_id = 'a'").withColumn("event_id", F.lit("c"))
    append_unseen(part, paths)
    for _ in range(2):
        append_unseen(again.union(part), paths)
    typed = read_table(spark, paths.typed, TYPED_COLUMNS, schema=TYPED_SCHEMA)
    assert sorted(r["event_id"] for r in typed.collect()) == ["a", "b", "c"]


def test_null_and_changed_timestamps(spark, scratch):
    paths = LayerPaths.under(scratch, source=f"{scratch}/source")
    odd = [event("click", "n", ts=None), event("click", "g", ts="garbage"), event("click", "x", ts=_on(2))]
    _drain(spark, paths, odd, 0)
    typed = _drain(spark, paths, odd, 10)
    assert sorted(r["event_id"] for r in typed.collect()) == ["g", "n", "x"]
    # with another timestamp an id is found only in the whole table
    moved = event("click", "x", ts=_on(9))
    typed = _drain(spark, paths, [moved], 20, anywhere=True)
    assert typed.where("event_id = 'x'").count() == 1


def test_empty_batch(spark, scratch):
    paths = LayerPaths.under(scratch, source=f"{scratch}/source")
    assert _drain(spark, paths, [], 0).count() == 0
    typed = _drain(spark, paths, ["no json"], 5)
    assert typed.count() == 0 and typed.columns == TYPED_COLUMNS


def test_only_the_days_of_a_batch_are_read(spark, scratch):
    paths = LayerPaths.under(scratch, source=f"{scratch}/source")
    _drain(spark, paths, [event("click", f"e_{d}", ts=_on(d)) for d in range(1, 29)], 0)
    known = read_table(spark, paths.typed, TYPED_COLUMNS, schema=TYPED_SCHEMA)
    raw = read_table(spark, paths.raw, RAW_COLUMNS, schema=RAW_SCHEMA)
    batch = parse_typed(raw, carry=LINEAGE_COLUMNS).where("event_id IN ('e_2', 'e_3', 'e_20')")
    spark.conf.set("spark.sql.maxMetadataStringLength", 2000)
    try:
        plan = unseen(batch, known)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    scan = next(part for part in plan.split("FileScan") if paths.typed.split("/")[-2] in part)
    assert "GreaterThanOrEqual(event_timestamp,2024-01-02" in scan.replace(" ", "")
    assert "GreaterThanOrEqual(event_timestamp,2024-01-20" in scan.replace(" ", "")
    assert close_gaps([dt.date(2024, 1, d) for d in (2, 3, 20)]) == [
        (dt.date(2024, 1, 2), dt.date(2024, 1, 3)), (dt.date(2024, 1, 20), dt.date(2024, 1, 20))]


def test_a_stream_sinks_table_is_refused(spark, scratch):
    paths = LayerPaths.under(scratch, source=f"{scratch}/source")
    records(spark, [event("click", "a")]).write.parquet(paths.source)
    await_query(start_raw_stream(spark, paths), 600)
    await_query(start_typed_stream(spark, paths), 600)
    with pytest.raises(ValueError, match="streaming file sink"):
        start_typed_lookup_stream(spark, paths)
