"""The layer tables of one dataset, built once; each layer is read from the
table below it.

``events`` -> topic records -> raw table -> typed table.  Each table is a
Spark write to a folder under the cluster's shared checkpoint root, keyed by
the listing of the input files (path, length, modification time; on any file
system Spark reads) and this package's source, so a changed input or changed
code never reads a stale layer.  A table counts as present only when its
``_SUCCESS`` marker exists (written at job commit), so a write interrupted
by a lost executor or driver is simply redone.
"""

from __future__ import annotations

import hashlib
import threading
from functools import cached_property
from importlib.resources import files

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from campaignlake.operators.raw import to_raw
from campaignlake.operators.typed import typed_events
from campaignlake.schemas import (
    EVENTS_SCHEMA,
    RAW_COLUMNS,
    RAW_PARTITION_COLUMNS,
    RAW_SCHEMA,
    TYPED_COLUMNS,
    TYPED_PARTITION_COLUMNS,
    TYPED_SCHEMA,
)
from campaignlake.session import file_exists, pin_session, scratch_path, session_conf
from campaignlake.sinks.tables import write_table
from campaignlake.sources.fixtures import kafka_records
from campaignlake.sources.tables import read_table
from campaignlake.sources.topic import read_records

_BUILD_LOCK = threading.RLock()
SEGMENT_EVENTS = 500_000
# raw rows are sorted by folder in each writing task: about a segment, compressed
RAW_SPLIT_BYTES = 32 << 20
COMPRESSED = {"compression": "zstd"}


def _sources(folder, prefix: str = ""):
    """(name, bytes) of the package's modules, also where it is shipped as a zip."""
    for entry in sorted(folder.iterdir(), key=lambda e: e.name):
        if entry.is_dir():
            yield from _sources(entry, f"{prefix}{entry.name}/")
        elif entry.name.endswith(".py"):
            yield prefix + entry.name, entry.read_bytes()


def _code_version() -> str:
    h = hashlib.sha1()
    for name, data in _sources(files("campaignlake")):
        h.update(name.encode())
        h.update(data)
    return h.hexdigest()[:12]


def _listing(spark: SparkSession, path: str) -> DataFrame:
    """path, length and modificationTime of the files below ``path``; contents aren't read."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    return reader.load(path).select("path", "length", "modificationTime")


def input_bytes(spark: SparkSession, path: str) -> int:
    return _listing(spark, path).agg(F.sum("length")).first()[0] or 0


def _input_fingerprint(spark: SparkSession, sf_dir: str, tables: tuple[str, ...]) -> str:
    h = hashlib.sha1(sf_dir.encode())
    for t in tables:
        marks = F.xxhash64("path", "length", "modificationTime").cast("decimal(38,0)")
        n, total = _listing(spark, f"{sf_dir}/{t}.parquet").agg(F.count("*"), F.sum(marks)).first()
        h.update(f"{t}:{n}:{total}".encode())
    return h.hexdigest()[:12]


class Lake:
    """Layer tables derived from the ``events`` table in ``sf_dir``."""

    def __init__(self, spark: SparkSession, sf_dir: str, root: str | None = None):
        pin_session(spark)
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        key = f"{_input_fingerprint(spark, self.sf_dir, ('events',))}-{_code_version()}"
        self.root = (root or scratch_path(spark, "lake", key)).rstrip("/")

    # -- inputs ---------------------------------------------------------
    def events(self) -> DataFrame:
        return self.spark.read.schema(EVENTS_SCHEMA).parquet(f"{self.sf_dir}/events.parquet")

    # -- paths ------------------------------------------------------------
    @cached_property
    def topic_path(self) -> str:
        return f"{self.root}/topic"

    @cached_property
    def raw_path(self) -> str:
        return f"{self.root}/raw"

    @cached_property
    def typed_path(self) -> str:
        return f"{self.root}/typed"

    def _ready(self, path: str) -> bool:
        return file_exists(self.spark, f"{path}/_SUCCESS")

    def _ensure(self, path: str, write) -> None:
        """Run ``write`` unless the table at ``path`` is complete.  Builds in
        one driver are serialized, so concurrent callers never both write."""
        if self._ready(path):
            return
        with _BUILD_LOCK:
            if not self._ready(path):
                write()

    # -- layers -----------------------------------------------------------
    def topic(self) -> DataFrame:
        """Kafka-shaped records of every event (the producer's output)."""

        def write():
            # like a topic's log segments: files follow one another in time, at least
            # one per core so readers get parallel input, of SEGMENT_EVENTS events at most
            events = self.events()
            segments = max(self.spark.sparkContext.defaultParallelism, -(-events.count() // SEGMENT_EVENTS))
            records = kafka_records(events, segments=segments)
            write_table(records, self.topic_path, rebalance=False, options=COMPRESSED)

        self._ensure(self.topic_path, write)
        return read_records(self.spark, self.topic_path)

    def raw(self) -> DataFrame:
        """The raw table, partitioned by (event_date, event_type).

        Rows are written where they are read: a segment spans few days, so there are
        few files in a folder without a shuffle of the payloads."""

        def write():
            rows = to_raw(self.topic())
            with session_conf(self.spark, {"spark.sql.files.maxPartitionBytes": str(RAW_SPLIT_BYTES)}):
                write_table(
                    rows, self.raw_path, partition_by=RAW_PARTITION_COLUMNS, rebalance=False, options=COMPRESSED
                )

        self._ensure(self.raw_path, write)
        return read_table(self.spark, self.raw_path, RAW_COLUMNS, schema=RAW_SCHEMA)

    def typed(self) -> DataFrame:
        """The typed, deduplicated table, partitioned by event_type."""
        self._ensure(
            self.typed_path,
            lambda: write_table(
                typed_events(self.raw()),
                self.typed_path,
                partition_by=TYPED_PARTITION_COLUMNS,
                rebalance=False,  # the dedup's shuffle has dealt the rows; there are few types
                options=COMPRESSED,
                cluster_by=["event_timestamp"],
            ),
        )
        return read_table(self.spark, self.typed_path, TYPED_COLUMNS, schema=TYPED_SCHEMA)

    def build(self) -> None:
        self.typed()

    def scratch(self, *parts: str) -> str:
        """A fresh folder for one run (streams need their own checkpoints)."""
        return scratch_path(self.spark, "runs", *parts, unique=True)
