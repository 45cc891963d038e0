"""Helpers shared by the training-data operators: scratch tables, words, batches."""

from __future__ import annotations

import atexit
import contextlib
import ctypes
import os
import tempfile
import uuid
import zipfile
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from campaignlake.session import checkpoint_root

_ASCII_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_ASCII_LOWER = "abcdefghijklmnopqrstuvwxyz"

#: Byte map for words: A-Z to a-z, digits, letters and all bytes of non-ASCII
#: characters stay, every other ASCII byte becomes a blank.
WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b > 127 else 32
    for b in range(256)
)

_SCRATCH: list[tuple[SparkSession, str]] = []


_BATCH_ROWS = 2000
_BATCH_BYTES = 8 << 20
_BROADCAST_REJECTED = 1_500_000


def ship(spark: SparkSession) -> None:
    """Give the executors this package (once per context), wherever they start.

    Spark's own file distribution sends it; the archive is a driver-side file only.
    Batches to Python have ``_BATCH_ROWS`` rows and about ``_BATCH_BYTES`` bytes at most:
    rows here are whole texts, and a pair of long ones may come thousands of times.
    """
    sc = spark.sparkContext
    rows = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(rows)) <= _BATCH_ROWS:
        spark.conf.set(rows, _BATCH_ROWS)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", _BATCH_BYTES)
    if getattr(sc, "_campaignlake_shipped", False):
        return
    top = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    archive = os.path.join(tempfile.mkdtemp(prefix="campaignlake-code-"), "campaignlake.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for folder, _, names in os.walk(os.path.join(top, "campaignlake")):
            for name in sorted(names):
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    out.write(path, os.path.relpath(path, top))
    sc.addPyFile(archive)
    sc._campaignlake_shipped = True


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new folder under the shared ``spark.checkpoint.dir``; removed at exit."""
    path = f"{checkpoint_root(spark)}/llm/{name}-{uuid.uuid4().hex}"
    _SCRATCH.append((spark, path))
    return path


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back.

    Cuts the lineage and pins the rows: what follows sees one version of them,
    also when an executor is lost and tasks run again.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@atexit.register
def release_scratch() -> None:
    """Delete the scratch folders of this process (DataFrames built on them end)."""
    while _SCRATCH:
        spark, path = _SCRATCH.pop()
        try:
            jvm = spark.sparkContext._jvm
            target = jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
        except Exception:  # the session may have ended before the process
            continue


def lower_ascii(column):
    """Lower-case A-Z only, as a Column."""
    return F.translate(column, _ASCII_UPPER, _ASCII_LOWER)


def staying_rows(docs: DataFrame, decided: DataFrame, digest) -> DataFrame:
    """The rows of ``docs`` that ``decided`` keeps, with all their columns.

    ``decided`` has a row (doc_id, digest, kept) for each row of ``docs``; ``digest``
    is the same value as a Column over ``docs``. Rows that repeat both are one
    document, of which one row stays at most.

    Up to ``_BROADCAST_REJECTED`` rejected keys go to all tasks, so that no text is
    shuffled; where more are rejected, both sides are shuffled by key.
    """
    keys = decided.groupBy("doc_id", "digest").agg(F.max("kept").alias("kept"), F.count("*").alias("rows"))
    keys = materialize(keys, "decided")
    bad = keys.where("not kept").select(
        F.col("doc_id").alias("__bad_id"), F.col("digest").alias("__bad_digest")
    )
    match = F.col("doc_id").eqNullSafe(F.col("__bad_id")) & (digest == F.col("__bad_digest"))
    if bad.count() <= _BROADCAST_REJECTED:
        bad = F.broadcast(bad)
    staying = docs.join(bad, match, "left_anti")
    if keys.where("rows > 1").limit(1).isEmpty():
        return staying
    tagged = staying.withColumn("__kept_digest", digest)
    return tagged.dropDuplicates(["doc_id", "__kept_digest"]).drop("__kept_digest")


def text_digest(column="text"):
    """A hash that tells rows with one doc_id and different texts apart."""
    return F.xxhash64(F.coalesce(F.col(column), F.lit("")))


def without_rows(docs: DataFrame, rejected: DataFrame) -> DataFrame:
    """The rows of ``docs`` that have no row (doc_id, digest) in ``rejected``."""
    bad = rejected.select(F.col("doc_id").alias("__bad_id"), F.col("digest").alias("__bad_digest"))
    bad = materialize(bad.distinct(), "rejected")
    match = F.col("doc_id").eqNullSafe(F.col("__bad_id")) & (text_digest() == F.col("__bad_digest"))
    return docs.join(bad, match, "left_anti")


_KEPT: dict[str, object] = {}


def keep_in_worker(key: str, make):
    """A value that this worker keeps for its next tasks: that of the last key only."""
    if key not in _KEPT:
        release()
        _KEPT[key] = make()
    return _KEPT[key]


def release(but: str | None = None) -> None:
    """Drop what tasks of other stages left in this worker, and give free memory back."""
    other = [key for key in _KEPT if key != but]
    for key in other:
        del _KEPT[key]
    if other:
        give_back()


def give_back() -> None:
    """Return free memory to the system; allocators keep what a large task freed."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # other C libraries have no trim
        ctypes.CDLL(None).malloc_trim(0)


def tidy(run, key: str | None = None):
    """``run`` over batches, in a worker that holds nothing of other stages.

    Workers serve the tasks of all stages. ``key`` names what ``run`` itself keeps for
    its next tasks; free memory goes back when the task ends.
    """

    def task(batches):
        release(but=key)
        try:
            yield from run(batches)
        finally:
            give_back()

    return task


def utf8(text: str | None) -> bytes:
    """UTF-8 bytes of a text; null is empty."""
    return text.encode("utf-8", "surrogatepass") if text else b""


def word_bytes(text: str | None) -> list[bytes]:
    """Words ``[0-9a-z and non-ASCII]+`` of a text after lower-casing A-Z."""
    return utf8(text).translate(WORD_BYTES).split()


def mix64(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer: every input bit changes about half of the output bits."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_WORD_BASE = np.uint64(0x9E3779B97F4A7C15)
_WORDS_AT_ONCE = 1 << 15


def word_hashes(texts: Iterable[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words of the texts in order, and words per text.

    Array operations over the joined bytes, ``_WORDS_AT_ONCE`` words at a time: a
    word's hash is the polynomial of its bytes, mixed with its length.
    """
    parts = [utf8(t).translate(WORD_BYTES) for t in texts]
    sizes = np.fromiter(map(len, parts), np.int64, len(parts))
    data = np.frombuffer(b" ".join(parts) + b" ", np.uint8)
    inside = data != 32
    edges = np.flatnonzero(np.diff(np.concatenate(([False], inside)).astype(np.int8)))
    starts, ends = edges[0::2], edges[1::2]
    if not len(starts):
        return np.zeros(0, np.uint64), np.zeros(len(parts), np.int64)
    lengths = ends - starts
    powers = np.cumprod(np.full(int(lengths.max()), _WORD_BASE, np.uint64))
    hashes = np.empty(len(starts), np.uint64)
    for a in range(0, len(starts), _WORDS_AT_ONCE):
        size = lengths[a : a + _WORDS_AT_ONCE]
        b = a + len(size)
        span = slice(starts[a], ends[b - 1])
        letters = data[span][inside[span]].astype(np.uint64)
        first = np.concatenate(([0], np.cumsum(size)[:-1]))
        letters *= powers[np.arange(len(letters)) - np.repeat(first, size)]
        hashes[a:b] = np.add.reduceat(letters, first)
    hashes = mix64(hashes + lengths.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    limits = np.cumsum(sizes + 1)
    counts = np.diff(np.concatenate(([0], np.searchsorted(starts, limits))))
    return hashes, counts


def slices(frames: Iterator[pd.DataFrame], column: str, size: int) -> Iterator[pd.DataFrame]:
    """Cut frames so that the texts of a slice have about ``size`` characters.

    A slice has one row at least, so a longer text is a slice of its own.
    """
    for frame in frames:
        if not len(frame):
            continue
        chars = frame[column].map(lambda t: len(t) if t else 0).to_numpy()
        group = np.cumsum(chars) // size
        cuts = np.flatnonzero(np.diff(group)) + 1
        for a, b in zip([0, *cuts], [*cuts, len(frame)], strict=True):
            yield frame.iloc[a:b]
