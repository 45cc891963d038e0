"""The event topic as a source: Kafka when the connector is present, else
files holding records of the same shape.

Kafka options of the raw layer: read from the earliest offset, do not
fail when retention removed data, 60 s request/session timeouts.  Transport
security (SASL/TLS) is given by the caller as ``kafka.*`` options; no secret
is read or stored here.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from campaignlake.schemas import KAFKA_SCHEMA

# Source options of the raw layer.
DEFAULT_KAFKA_OPTIONS = {
    "startingOffsets": "earliest",
    "failOnDataLoss": "false",
    "kafka.request.timeout.ms": "60000",
    "kafka.session.timeout.ms": "60000",
}


def kafka_options(
    bootstrap_servers: str,
    topic: str,
    security: dict[str, str] | None = None,
    group_id: str | None = None,
    min_partitions: int | None = None,
    max_offsets_per_trigger: int | None = None,
    **extra: str,
) -> dict[str, str]:
    """Options for ``format("kafka")``.  ``security`` carries e.g.
    ``kafka.security.protocol``, ``kafka.sasl.mechanism`` and
    ``kafka.sasl.jaas.config`` built by the caller from its secret store.

    Scale knobs: a topic with few partitions gives one Spark task per topic
    partition; ``min_partitions`` (e.g. the cluster's core count) splits
    offset ranges into more tasks.  ``max_offsets_per_trigger`` bounds each
    micro-batch, which ``availableNow`` honours, so a large backlog drains
    as several retryable batches instead of one."""
    opts = dict(DEFAULT_KAFKA_OPTIONS)
    opts["kafka.bootstrap.servers"] = bootstrap_servers
    opts["subscribe"] = topic
    if group_id:
        opts["kafka.group.id"] = group_id
    if min_partitions:
        opts["minPartitions"] = str(min_partitions)
    if max_offsets_per_trigger:
        opts["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    opts.update(security or {})
    opts.update(extra)
    return opts


def read_kafka_stream(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    """Streaming Kafka source (needs the spark-sql-kafka connector)."""
    return spark.readStream.format("kafka").options(**options).load()


def read_records_stream(
    spark: SparkSession,
    path: str,
    fmt: str = "parquet",
    max_files_per_trigger: int | None = None,
    ignore_missing_files: bool = False,
) -> DataFrame:
    """Streaming read of Kafka-shaped records stored as files.

    A file that disappears before it is read fails the query; with
    ``ignore_missing_files`` its records are left out without a trace.
    """
    reader = spark.readStream.format(fmt).schema(KAFKA_SCHEMA)
    if ignore_missing_files:
        reader = reader.option("ignoreMissingFiles", "true")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.load(path)


def read_records(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Batch read of Kafka-shaped records stored as files."""
    return spark.read.format(fmt).schema(KAFKA_SCHEMA).load(path)
