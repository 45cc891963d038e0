"""Layer tables as batch and streaming sources.

Storage format is a parameter: ``parquet`` is what this environment can run;
``delta`` works unchanged where the Delta jars are on the classpath.
Partition columns of a Parquet table come back last on read, so every read
re-selects the layer's column contract.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def read_table(
    spark: SparkSession,
    path: str,
    columns: list[str] | None = None,
    fmt: str = "parquet",
    merge_schema: bool = False,
    schema: StructType | None = None,
) -> DataFrame:
    """Batch scan of a layer table.

    A declared ``schema`` (the layer's contract) skips schema inference,
    which otherwise costs a footer-reading job per read; ``merge_schema``
    instead unions file schemas (Parquet's read-side form of additive
    schema evolution)."""
    reader = spark.read.format(fmt)
    if merge_schema and fmt == "parquet":
        reader = reader.option("mergeSchema", "true")
    elif schema is not None and fmt != "delta":
        reader = reader.schema(schema)
    df = reader.load(path)
    return df.select(*columns) if columns else df


def read_table_stream(
    spark: SparkSession,
    path: str,
    schema: StructType,
    columns: list[str] | None = None,
    fmt: str = "parquet",
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """Incremental read of a layer table written by a streaming sink.

    The file source follows the sink's commit log, so files of an
    unfinished batch are never read.
    """
    reader = spark.readStream.format(fmt)
    if fmt != "delta":
        reader = reader.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    df = reader.load(path)
    return df.select(*columns) if columns else df


def describe_schema(df: DataFrame) -> str:
    """Tree form of the schema (what ``printSchema`` prints), as a value."""
    return df.schema.treeString()
