"""Positions in scan order, and the batches and shards that follow from them.

Rows are ordered by ``(src_file, src_row)``.  Counts per block of source rows
are small next to the rows, so running sums over them give every block its
offset, and a position is the offset plus the rank within the block.  No task
sees more than one block of rows, however the rows spread over files.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gleanery.session import hint_if_small, row_bytes, stored

BLOCK_ROWS = 50_000


def row_block(block_rows: int) -> Column:
    """The block of source rows that a row lies in."""
    return F.expr(f"src_row div {block_rows}")


def block_offsets(df: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``src_file, block, block_offset``: rows before each block in scan order."""
    counts = df.groupBy("src_file", row_block(block_rows).alias("block")).agg(F.count("*").alias("n"))
    earlier = (Window.unboundedPreceding, -1)
    in_file = Window.partitionBy("src_file").orderBy("block").rowsBetween(*earlier)
    blocks = counts.withColumn("in_file", F.coalesce(F.sum("n").over(in_file), F.lit(0)))
    # One row per file; the driver lists as many to plan the scan.
    by_file = Window.orderBy("src_file").rowsBetween(*earlier)
    files = (
        counts.groupBy("src_file")
        .agg(F.sum("n").alias("n"))
        .select("src_file", F.coalesce(F.sum("n").over(by_file), F.lit(0)).alias("before_file"))
    )
    return blocks.join(files, "src_file").select(
        "src_file", "block", (F.col("before_file") + F.col("in_file")).alias("block_offset")
    )


def with_position(df: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Add ``pos``, 1..N in scan order.

    ``df`` is read twice, once for the two position columns only; a model
    column must be stored before.
    """
    in_block = Window.partitionBy("src_file", "block").orderBy("src_row")
    ranked = df.withColumn("block", row_block(block_rows)).withColumn("in_block", F.row_number().over(in_block))
    return (
        ranked.join(block_offsets(df, block_rows), ["src_file", "block"])
        .withColumn("pos", F.col("block_offset") + F.col("in_block"))
        .select(*df.columns, "pos")
    )


def with_batch(df: DataFrame, batch_size: int) -> DataFrame:
    """Add ``pos`` and ``batch``, 1-based; the last batch may be partial."""
    return with_position(df).withColumn("batch", F.ceil(F.col("pos") / F.lit(batch_size)).cast("bigint"))


def with_shard(df: DataFrame, rows_per_shard: int = 100, start: int = 1) -> DataFrame:
    """Add ``pos``, ``shard`` and ``shard_name``."""
    shard = (F.lit(start) + F.floor((F.col("pos") - 1) / F.lit(rows_per_shard))).cast("bigint")
    return (
        with_position(df)
        .withColumn("shard", shard)
        .withColumn("shard_name", F.format_string("shard-%05d", F.col("shard")))
    )


def cap(df: DataFrame, batch_size: int, num_batches: int | None) -> DataFrame:
    """The first ``num_batches * batch_size`` rows in scan order; all if the count is None or 0.

    Only the place of the last row wanted is looked up, from the position
    columns.  The rows are then filtered by it, which needs no shuffle and
    skips the files behind it.
    """
    if not num_batches:
        return df
    last = (
        with_position(df.select("src_file", "src_row")).where(F.col("pos") == num_batches * batch_size).first()
    )
    if last is None:
        return df
    file, row = F.lit(last["src_file"]), F.lit(last["src_row"])
    return df.where(
        (F.col("src_file") <= file) & ((F.col("src_file") < file) | (F.col("src_row") <= row))
    )


def shard_edges(df: DataFrame, rows_per_shard: int, block_rows: int) -> DataFrame:
    """Per block of source rows: where shards start in it and how many started before.

    About one number per shard, against one row per row of ``df``.
    """
    placed = with_position(df.select("src_file", "src_row"), block_rows)
    starts_here = (F.col("pos") - 1) % rows_per_shard == 0
    first = F.min("pos")
    return placed.groupBy("src_file", row_block(block_rows).alias("block")).agg(
        F.ceil((first - 1) / F.lit(rows_per_shard)).cast("bigint").alias("started"),
        F.sort_array(F.collect_list(F.when(starts_here, F.col("src_row")))).alias("starts"),
        F.max("pos").alias("last_pos"),
    )


def attach_shard(df: DataFrame, rows_per_shard: int) -> tuple[DataFrame, int]:
    """``df`` with a 0-based ``shard_index``, and the number of rows.

    The result equals ``with_shard`` but leaves wide rows where they are: only
    the edges are sent to them while they are small enough to broadcast.
    """
    block_rows = max(1024, min(16 * rows_per_shard, 65_536))
    edges = stored(shard_edges(df, rows_per_shard, block_rows))
    seen = edges.agg(F.max("last_pos").alias("rows"), F.sum(row_bytes(edges)).alias("bytes")).first()
    row = F.col("src_row")
    started_here = F.size(F.filter("starts", lambda s: s <= row))
    placed = (
        df.withColumn("block", row_block(block_rows))
        .join(hint_if_small(edges.drop("last_pos"), seen["bytes"] or 0), ["src_file", "block"])
        .withColumn("shard_index", (F.col("started") + started_here - 1).cast("bigint"))
    )
    return placed.select(*df.columns, "shard_index"), seen["rows"] or 0


def running_totals(
    df: DataFrame, group: str, order: Sequence[str], cols: Sequence[str], block: Column
) -> DataFrame:
    """Add ``cum_<col>``: running sums within ``group`` along ``order``.

    ``block`` cuts the last order column into ranges; sums over ranges are
    carried forward, so that a task runs over one range at a time.
    """
    *lead, last = order
    keyed = df.withColumn("_block", block)
    ranges = keyed.groupBy(group, *lead, "_block").agg(*[F.sum(c).alias(c) for c in cols])
    before = Window.partitionBy(group).orderBy(*lead, "_block").rowsBetween(Window.unboundedPreceding, -1)
    carried = ranges.select(
        group, *lead, "_block", *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"_{c}") for c in cols]
    )
    inside = (
        Window.partitionBy(group, *lead, "_block")
        .orderBy(last)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return (
        keyed.select("*", *[F.sum(c).over(inside).alias(f"_in_{c}") for c in cols])
        .join(carried, [group, *lead, "_block"])
        .select(*df.columns, *[(F.col(f"_{c}") + F.col(f"_in_{c}")).alias(f"cum_{c}") for c in cols])
    )
