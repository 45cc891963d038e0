"""Session construction and the few session settings the layers rely on."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings every layer depends on.  The time zone is pinned because the raw
# layer dates an event from its ISO string (UTC day) while the metrics layer
# dates it from a timestamp in the session zone; in UTC both agree.
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
}

DEFAULT_CONF = {
    **REQUIRED_CONF,
    "spark.ui.enabled": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # Exact stream dedup keeps one key per event id: keep that state off-heap.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # each batch uploads the changed keys, not a snapshot of all of them
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


MB = 1 << 20


def scale_conf(input_bytes: int, cores: int, target_partition_mb: int = 256) -> dict[str, str]:
    """Partition sizing for a job reading ``input_bytes`` on ``cores`` cores.

    Scan splits and shuffle partitions of about ``target_partition_mb`` keep
    each task's working set well inside executor memory (sort and aggregate
    buffers spill beyond it), and at least two waves of tasks keep every core
    busy.  AQE then coalesces shuffle partitions that turn out small (after
    partial aggregation most do) and splits skewed ones, so the number set
    here is an upper bound, not a guess to tune per query.  For 100 TB on
    8,000 cores: 256 MB splits and 400,000 shuffle partitions.
    """
    target = target_partition_mb * MB
    partitions = max(2 * cores, -(-input_bytes // target))
    return {
        "spark.sql.files.maxPartitionBytes": str(target),
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target),
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": str(16 * MB),
    }


def build_session(
    master: str | None = None,
    app_name: str = "campaignlake",
    shuffle_partitions: int | None = None,
    extra_conf: dict[str, str] | None = None,
    input_bytes: int | None = None,
    cores: int | None = None,
) -> SparkSession:
    """Build (or get) a session with the library defaults.

    On a cluster pass ``master=None`` and let spark-submit decide.  Give
    ``input_bytes`` and ``cores`` to size splits and shuffle partitions with
    :func:`scale_conf`, or set ``shuffle_partitions`` directly (tests and
    local runs use the core count).
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if input_bytes and cores:
        conf.update(scale_conf(input_bytes, cores))
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    pin_session(spark)
    return spark


def pin_session(spark: SparkSession) -> None:
    """Apply the settings the layers' semantics depend on (idempotent)."""
    for k, v in REQUIRED_CONF.items():
        if spark.conf.get(k, None) != v:
            spark.conf.set(k, v)


@contextmanager
def session_conf(spark: SparkSession, settings: dict[str, str]):
    """Settings for what starts inside; the session's own come back after."""
    previous = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in previous.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def apply_storage_conf(spark: SparkSession, conf: dict[str, str]) -> None:
    """Set object-store access for this session (e.g. an account key or
    OAuth settings under ``fs.<scheme>.*``), given by the caller from its
    secret store; nothing is read from the environment here."""
    for k, v in conf.items():
        spark.conf.set(k, v)


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Only when the setting is absent (a test or a laptop) is a private folder
    made and recorded on the context, so later calls agree.
    """
    sc = spark.sparkContext
    root = sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not root:
        root = tempfile.mkdtemp(prefix="campaignlake-ckpt-")
        sc.setCheckpointDir(root)
        root = sc.getCheckpointDir() or root
    return root.rstrip("/")


def scratch_path(spark: SparkSession, *parts: str, unique: bool = False) -> str:
    """A path below the checkpoint root; ``unique`` appends a fresh id."""
    pieces = [checkpoint_root(spark), "campaignlake", *parts]
    if unique:
        pieces.append(uuid.uuid4().hex[:12])
    return "/".join(p.strip("/") if i else p for i, p in enumerate(pieces))


def file_exists(spark: SparkSession, path: str) -> bool:
    """Whether the file ``path`` exists, on whatever file system its URI names.

    Uses the reader's own path check (a listing on the driver, no job), so
    object stores and HDFS are handled exactly as a read would handle them.
    """
    from pyspark.errors import AnalysisException

    try:
        spark.read.format("text").load(path)
        return True
    except AnalysisException:
        return False
