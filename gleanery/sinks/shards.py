"""Numbered shards: writing, numbering over runs and compaction."""

from __future__ import annotations

import math

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gleanery.operators.position import BLOCK_ROWS, attach_shard, block_offsets, row_block
from gleanery.operators.project import conform
from gleanery.session import hint_if_small, stored
from gleanery.sources.files import file_manifest
from gleanery.sources.scan import file_path, with_source

# A directory per shard, a directory per range of shards, or a plain file.
_NUMBERED = r"(?:^|/)(?:shard=(\d+)/|shards=\d+-(\d+)/|shard-(\d+)\.parquet$)"


def next_shard(spark: SparkSession, path: str, start: int = 1) -> int:
    """One more than the highest existing shard number; other names are ignored."""
    try:
        files = file_manifest(spark, path, "*.parquet", recursive=True)
        rel = F.col("rel_path")
        number = F.coalesce(
            *[F.nullif(F.regexp_extract(rel, _NUMBERED, i), F.lit("")).cast("bigint") for i in (1, 2, 3)]
        )
        last = files.agg(F.max(number).alias("last")).first()["last"]
    except FileNotFoundError:
        last = None
    return start if last is None else last + 1


def read_shards(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The rows of all shards with ``shard``, ``src_file`` and ``src_row``.

    Reads every layout side by side, also plain ``shard-NNNNN.parquet`` files;
    other files are left out. The tail of such a file's name need not be a
    number; then ``shard`` is NULL.
    """
    with_number = T.StructType(list(schema.fields)).add("shard", T.LongType())
    reader = spark.read.schema(with_number).option("recursiveFileLookup", "true")
    try:
        rows = reader.option("pathGlobFilter", "*.parquet").parquet(path)
    except AnalysisException as exc:
        if "PATH_NOT_FOUND" not in str(exc):
            raise
        raise FileNotFoundError(f"no such folder: {path}") from exc
    file = file_path()
    named = [F.nullif(F.regexp_extract(file, _NUMBERED, i), F.lit("")).cast("bigint") for i in (1, 3)]
    numbered = rows.select(
        *schema.names,
        F.coalesce(*named, F.col("shard")).alias("shard"),
        file.alias("src_file"),
        F.col("_metadata.row_index").alias("src_row"),
    )
    return numbered.where(F.col("shard").isNotNull() | F.col("src_file").rlike(r"/shard-[^/]*\.parquet$"))


def write_shards(
    df: DataFrame,
    path: str,
    schema: T.StructType,
    rows_per_shard: int = 100,
    compression: str = "snappy",
    start: int | None = None,
    one_file: bool = True,
    ranges: bool = False,
) -> int:
    """Write ``df`` in scan order as shards of at most ``rows_per_shard`` rows.

    Each shard becomes one file in its own ``shard=NNNNN`` directory.  With
    ``ranges``, meant for very many shards, the shards of a write share one
    directory, whole shards per file, with ``shard`` as a column; the layout
    follows from this argument alone.  Numbers go on from the
    highest existing one; passing ``start`` replaces the shards that an
    interrupted write of the same rows left behind.

    The wide rows are shuffled once, into at most ``spark.sql.shuffle.partitions``
    tasks.  Without ``one_file`` they are not shuffled at all: every task writes
    the parts of shards that it has read, so a shard on the border of two input
    splits gets two files.  Returns the number of shards written.
    """
    spark = df.sparkSession
    first = start if start is not None else next_shard(spark, path)
    placed, rows = attach_shard(df, rows_per_shard)
    if not rows:
        return 0
    count = math.ceil(rows / rows_per_shard)
    placed = placed.withColumn("_shard", F.col("shard_index") + first)
    if one_file:
        per_task = math.ceil(count / int(spark.conf.get("spark.sql.shuffle.partitions")))
        placed = placed.repartitionById(
            math.ceil(count / per_task), F.floor(F.col("shard_index") / per_task).cast("int")
        )
    if ranges:
        whole = f"{first:05d}-{first + count - 1:05d}"
        keys, partition = {"shards": F.lit(whole), "shard": F.col("_shard")}, "shards"
    else:
        keys, partition = {"shard": F.format_string("%05d", F.col("_shard"))}, "shard"
    shaped = placed.withColumns(keys).sortWithinPartitions(partition, "_shard", "src_file", "src_row")
    (
        conform(shaped, schema, *keys)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", compression)
        .partitionBy(partition)
        .parquet(path)
    )
    return count


def merge_shards(
    spark: SparkSession,
    src: str,
    dst: str,
    pattern: str = "*.parquet",
    schema: T.StructType | None = None,
    target_bytes: int = 512 * 1024 * 1024,
    compression: str = "snappy",
) -> int:
    """Rewrite the matching files of ``src`` as few files of about ``target_bytes``.

    Columns are united by name, rows stay in (file name, row) order over the
    numbered output files.  Returns the number of files.
    """
    if f"{dst.rstrip('/')}/".startswith(f"{src.rstrip('/')}/"):
        raise ValueError("the destination must lie outside the source folder")
    size = file_manifest(spark, src, pattern, recursive=True).agg(F.sum("length")).first()[0]
    if size is None:
        raise FileNotFoundError(f"no file matches {pattern!r} in {src}")
    rows = with_source(spark.read.option("mergeSchema", True).option("pathGlobFilter", pattern).parquet(src))
    columns = rows.columns[:-2]
    if schema is not None:
        if columns != schema.names:
            raise ValueError(f"columns {columns} do not match the schema {schema.names}")
        rows = conform(rows, schema, "src_file", "src_row")
    files = max(1, math.ceil(size / target_bytes))
    offsets = stored(block_offsets(rows.select("src_file", "src_row"), BLOCK_ROWS))
    total = rows.select("src_row").count()
    part = F.floor(F.col("block_offset") / max(1, math.ceil(total / files))).cast("int")
    (
        rows.withColumn("block", row_block(BLOCK_ROWS))
        .join(hint_if_small(offsets), ["src_file", "block"])
        .repartitionById(files, part)
        .sortWithinPartitions("src_file", "src_row")
        .select(*columns)
        .write.mode("overwrite")
        .option("compression", compression)
        .parquet(dst)
    )
    return files
