"""Incremental layers: stream = batch, reruns add nothing, dedup state
survives runs."""

from __future__ import annotations

from helpers import SF_SMALL, event, records

from campaignlake.plans.lake import Lake
from campaignlake.schemas import METRICS_COLUMNS, RAW_COLUMNS, RAW_SCHEMA, TYPED_COLUMNS, TYPED_SCHEMA
from campaignlake.sources.tables import read_table
from campaignlake.streaming import (
    LayerPaths,
    await_query,
    batches_with_data,
    progress_frame,
    run_layers,
    start_raw_stream,
    start_typed_stream,
)
from campaignlake.operators import campaign_metrics


def _same(a, b):
    assert a.count() == b.count()
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_stream_chain_equals_batch_and_rerun_adds_nothing(spark, scratch):
    lake = Lake(spark, SF_SMALL)
    lake.topic()
    paths = LayerPaths.under(scratch, source=lake.topic_path)
    run = run_layers(spark, paths, timeout_seconds=600, max_files_per_trigger=1)
    raw = read_table(spark, paths.raw, RAW_COLUMNS, schema=RAW_SCHEMA)
    typed = read_table(spark, paths.typed, TYPED_COLUMNS, schema=TYPED_SCHEMA)
    _same(raw.drop("ingested_at"), lake.raw().drop("ingested_at"))
    _same(typed.drop("ingested_at"), lake.typed().drop("ingested_at"))
    cols = [c for c in METRICS_COLUMNS if c != "updated_at"]
    metrics = read_table(spark, paths.metrics).select(*cols)
    _same(metrics, campaign_metrics(lake.typed()).select(*cols))
    assert batches_with_data(run.progress["raw"]) >= 1
    assert progress_frame(spark, run.progress).count() == len(run.progress["raw"]) + len(run.progress["typed"])

    n_raw, n_typed = raw.count(), typed.count()
    again = run_layers(spark, paths, timeout_seconds=600)
    assert batches_with_data(again.progress["raw"]) == 0
    assert read_table(spark, paths.raw).count() == n_raw
    assert read_table(spark, paths.typed).count() == n_typed


def test_dedup_state_survives_runs(spark, scratch):
    src = f"{scratch}/source"
    paths = LayerPaths.under(scratch, source=src)
    first = [event("click", f"e_{i}") for i in range(10)]
    second = [event("click", f"e_{i}") for i in range(5, 15)]  # 5 repeats
    records(spark, first).write.mode("append").parquet(src)
    for _ in range(2):
        await_query(start_raw_stream(spark, paths), 600)
        await_query(start_typed_stream(spark, paths), 600)
        records(spark, second, start_offset=100).write.mode("append").parquet(src)
    typed = read_table(spark, paths.typed)
    assert typed.count() == 15
    assert typed.select("event_id").distinct().count() == 15


def test_late_new_events_are_kept(spark, scratch):
    src = f"{scratch}/source"
    paths = LayerPaths.under(scratch, source=src)
    for k, ts in enumerate(["2024-01-10T10:00:00.000000+00:00", "2024-01-01T10:00:00.000000+00:00"]):
        part = [event("click", f"e_{k}", ts=ts)]
        records(spark, part, start_offset=k).write.mode("append").parquet(src)
        await_query(start_raw_stream(spark, paths), 600)
        await_query(start_typed_stream(spark, paths), 600)
    assert read_table(spark, paths.typed).count() == 2


def test_progress_outlives_what_spark_keeps():
    class Query:
        """Shows the last three of many batches, as a running query does."""

        def __init__(self):
            self.at = 0

        def awaitTermination(self, seconds):
            self.at += 2
            return self.at >= 300

        @property
        def recentProgress(self):
            return [{"batchId": k, "numInputRows": 1} for k in range(max(0, self.at - 3), self.at)]

        def exception(self):
            return None

    assert sum(p["numInputRows"] for p in await_query(Query())) == 300


def test_salted_stream_dedup_is_exact_across_runs(spark, scratch):
    src = f"{scratch}/source"
    paths = LayerPaths.under(scratch, source=src)
    hot = event("click", "e_hot")
    records(spark, [hot] * 40 + [event("click", f"e_{i}") for i in range(5)]).write.parquet(src)
    await_query(start_raw_stream(spark, paths), 600)
    await_query(start_typed_stream(spark, paths, dedup_salt_buckets=4), 600)
    records(spark, [hot] * 10 + [event("click", "e_new")], start_offset=500).write.mode("append").parquet(src)
    await_query(start_raw_stream(spark, paths), 600)
    await_query(start_typed_stream(spark, paths, dedup_salt_buckets=4), 600)
    typed = read_table(spark, paths.typed)
    assert typed.count() == 7
    assert typed.select("event_id").distinct().count() == 7


def test_failing_layer_stops_the_chain(spark, scratch):
    import os

    import pytest

    paths = LayerPaths.under(scratch, source=f"{scratch}/no-such-topic")
    with pytest.raises(Exception):
        run_layers(spark, paths, timeout_seconds=300)
    assert not os.path.exists(paths.typed) and not os.path.exists(paths.metrics)


def test_incremental_metrics_equal_full_recompute(spark, scratch):
    from pyspark.sql import functions as F

    topic = Lake(spark, SF_SMALL).topic()
    late = (F.col("offset") % 10 == 3)
    early = F.col("timestamp") < F.lit("2024-01-20").cast("timestamp")
    src = f"{scratch}/source"
    paths = LayerPaths.under(scratch, source=src)
    cols = [c for c in METRICS_COLUMNS if c != "updated_at"]

    topic.where(early & ~late).write.parquet(src)
    run_layers(spark, paths, timeout_seconds=600, incremental_metrics=True)
    first = read_table(spark, paths.metrics).select(*cols)
    typed_now = read_table(spark, paths.typed, TYPED_COLUMNS, schema=TYPED_SCHEMA)
    _same(first, campaign_metrics(typed_now).select(*cols))

    topic.where(~early | late).write.mode("append").parquet(src)  # new days plus late events for old days
    run_layers(spark, paths, timeout_seconds=600, incremental_metrics=True)
    typed_all = read_table(spark, paths.typed, TYPED_COLUMNS, schema=TYPED_SCHEMA)
    assert typed_all.count() == Lake(spark, SF_SMALL).typed().count()
    _same(read_table(spark, paths.metrics).select(*cols), campaign_metrics(typed_all).select(*cols))

    # nothing new: the refresh rewrites nothing and the table is unchanged
    run_layers(spark, paths, timeout_seconds=600, incremental_metrics=True)
    assert read_table(spark, paths.dirty_days).count() == 0
    _same(read_table(spark, paths.metrics).select(*cols), campaign_metrics(typed_all).select(*cols))


def test_three_way_stream_equals_single_pass_stream(spark, scratch):
    lake = Lake(spark, SF_SMALL)
    lake.topic()
    out = {}
    for single in (True, False):
        paths = LayerPaths.under(f"{scratch}/{single}", source=lake.topic_path)
        await_query(start_raw_stream(spark, paths), 600)
        await_query(start_typed_stream(spark, paths, single_pass=single), 600)
        out[single] = read_table(spark, paths.typed, TYPED_COLUMNS, schema=TYPED_SCHEMA).drop("ingested_at")
    _same(out[True], out[False])
    assert out[False].count() == lake.typed().count()


def test_state_partitions_are_scoped_to_the_stream(spark, scratch):
    import os

    src = f"{scratch}/source"
    paths = LayerPaths.under(scratch, source=src)
    records(spark, [event("click", f"e_{i}") for i in range(20)]).write.parquet(src)
    await_query(start_raw_stream(spark, paths), 600)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    await_query(start_typed_stream(spark, paths, state_partitions=3), 600)
    assert spark.conf.get("spark.sql.shuffle.partitions") == before
    state = os.path.join(paths.typed_checkpoint, "state", "0")
    parts = sorted(d for d in os.listdir(state) if d.isdigit())
    assert parts == ["0", "1", "2"]
    assert read_table(spark, paths.typed).count() == 20
