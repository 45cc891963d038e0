"""Sources, sinks and session helpers."""

from __future__ import annotations

import pytest
from helpers import event, records

from campaignlake.operators import to_raw
from campaignlake.schemas import KAFKA_SCHEMA, RAW_COLUMNS, RAW_SCHEMA
from campaignlake.session import apply_storage_conf, checkpoint_root, scale_conf, scratch_path
from campaignlake.sinks import write_table
from campaignlake.sources import kafka_options, read_records, read_table
from campaignlake.sources.tables import describe_schema


def test_kafka_options_defaults_and_pass_through():
    sec = {"kafka.security.protocol": "SASL_SSL", "kafka.sasl.mechanism": "PLAIN"}
    o = kafka_options("host:9093", "ad-events", security=sec, group_id="g1")
    assert o["subscribe"] == "ad-events" and o["kafka.bootstrap.servers"] == "host:9093"
    assert o["startingOffsets"] == "earliest" and o["failOnDataLoss"] == "false"
    assert o["kafka.request.timeout.ms"] == "60000" and o["kafka.session.timeout.ms"] == "60000"
    assert o["kafka.security.protocol"] == "SASL_SSL" and o["kafka.group.id"] == "g1"
    assert "minPartitions" not in o
    scaled = kafka_options("host:9093", "ad-events", min_partitions=4000, max_offsets_per_trigger=50_000_000)
    assert scaled["minPartitions"] == "4000" and scaled["maxOffsetsPerTrigger"] == "50000000"


def test_record_files_round_trip(spark, scratch):
    path = f"{scratch}/topic"
    records(spark, [event("click", "e_1")]).write.parquet(path)
    df = read_records(spark, path)
    assert df.schema == KAFKA_SCHEMA
    assert to_raw(df).first().event_type == "click"


def test_partitioned_table_round_trip_keeps_contract_order(spark, scratch):
    path = f"{scratch}/raw"
    raw = to_raw(records(spark, [event("click", "e_1"), event("impression", "e_2")]))
    write_table(raw, path, partition_by=["event_date", "event_type"])
    back = read_table(spark, path, RAW_COLUMNS, schema=RAW_SCHEMA)
    assert back.columns == RAW_COLUMNS and back.count() == 2
    assert "event_type=click" in " ".join(p for p in __import__("os").listdir(f"{path}/event_date=2024-01-01"))


def test_overwrite_of_own_input_is_refused(spark, scratch):
    path = f"{scratch}/t"
    records(spark, ["{}"]).write.parquet(path)
    df = read_records(spark, path)
    with pytest.raises(ValueError):
        write_table(df, path, source_paths=[path])


def test_describe_schema_and_storage_conf(spark):
    tree = describe_schema(to_raw(records(spark, ["{}"])))
    assert tree.startswith("root") and "raw_payload: string" in tree
    apply_storage_conf(spark, {"fs.test.example.key": "x"})
    assert spark.conf.get("fs.test.example.key") == "x"


def test_scratch_lives_under_checkpoint_root(spark):
    root = checkpoint_root(spark)
    assert root and scratch_path(spark, "a").startswith(root)
    assert scratch_path(spark, "a", unique=True) != scratch_path(spark, "a", unique=True)


def test_additive_schema_evolution_on_append(spark, scratch):
    path = f"{scratch}/evolving"
    v1 = spark.createDataFrame([("e_1", "click")], "event_id string, event_type string")
    v2 = spark.createDataFrame([("e_2", "click", "web")], "event_id string, event_type string, channel string")
    write_table(v1, path, mode="append")
    write_table(v2, path, mode="append")
    merged = read_table(spark, path, merge_schema=True)
    assert set(merged.columns) == {"event_id", "event_type", "channel"}
    assert sorted((r.event_id, r.channel) for r in merged.collect()) == [("e_1", None), ("e_2", "web")]


def test_scale_conf_sizes_partitions_to_the_data():
    tb100 = scale_conf(100 * 1024**4, cores=8000)
    assert tb100["spark.sql.shuffle.partitions"] == str(100 * 1024**4 // (256 * 1024**2))
    assert tb100["spark.sql.files.maxPartitionBytes"] == str(256 * 1024**2)
    small = scale_conf(10 * 1024**2, cores=8)
    assert small["spark.sql.shuffle.partitions"] == "16"  # two waves of tasks on 8 cores
