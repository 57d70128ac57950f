"""Whole-table writes, appends, publishing and quarantine."""

from __future__ import annotations

import logging
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gleanery.operators.project import conform
from gleanery.schemas import QUARANTINE
from gleanery.sources.files import file_manifest, glob_match, load_selected

log = logging.getLogger(__name__)


def write_table(
    df: DataFrame, path: str, schema: T.StructType | None = None, compression: str = "snappy"
) -> None:
    """Replace the table at ``path``; without rows, an empty table with the schema."""
    shaped = conform(df, schema) if schema is not None else df
    shaped.write.mode("overwrite").option("compression", compression).parquet(path)


def append_table(df: DataFrame, path: str, schema: T.StructType, compression: str = "snappy") -> None:
    """Add rows in the given schema, creating the table if it is absent."""
    conform(df, schema).write.mode("append").option("compression", compression).parquet(path)


def read_conformed(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A table that grew by appends under several schemas, in the current one."""
    return conform(spark.read.option("mergeSchema", True).parquet(path), schema)


def write_quarantine(df: DataFrame, path: str) -> None:
    """Keep failed rows by stage and run; a repeated run replaces its own."""
    (
        conform(df, QUARANTINE)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("stage", "run_id")
        .parquet(path)
    )


def publish(
    source: str | DataFrame,
    dest: str,
    spark: SparkSession | None = None,
    patterns: Sequence[str] = ("*.parquet",),
    file_filter: Callable[[Column], Column] | None = None,
    partition_by: Sequence[str] = (),
) -> DataFrame:
    """Add the rows of a table, or of the chosen files of one, to ``dest`` and list the files that came.

    Nothing in ``dest`` is removed or replaced; rows published twice are there twice.
    With a folder as source, ``patterns`` and ``file_filter`` choose files by
    their path below it; nothing chosen gives an empty manifest and a warning.
    """
    if isinstance(source, DataFrame):
        rows, spark = source, source.sparkSession
    else:
        manifest = file_manifest(spark, source, recursive=True)
        rel = F.col("rel_path")
        chosen = manifest.where(glob_match(rel, patterns))
        if file_filter is not None:
            chosen = chosen.where(file_filter(rel))
        if chosen.isEmpty():
            log.warning("no file chosen in %s, nothing to publish", source)
            return chosen
        rows = load_selected(spark, chosen, source)
    try:
        before = file_manifest(spark, dest, "*.parquet", recursive=True).select("path")
    except FileNotFoundError:
        before = None
    writer = rows.write.mode("append")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(dest)
    after = file_manifest(spark, dest, "*.parquet", recursive=True)
    return after if before is None else after.join(before, "path", "left_anti").orderBy("path")
