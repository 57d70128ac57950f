"""Leaving out the rows that an earlier run attempted."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gleanery.session import BROADCAST_BYTES, stored

# Runs of pending rows are cut at multiples of this many rows: a row is looked up among the runs of its block only.
BLOCK_ROWS = 1024
# Bytes that a run takes in a broadcast table, besides its file name.
INTERVAL_BYTES = 64


def identity(id_col: str) -> Column:
    """What tells a row from others over all runs: its id or, if that is empty or missing, its place."""
    place = F.concat(F.lit("\x00"), "src_file", F.lit("\x00"), F.col("src_row").cast("string"))
    own = F.col(id_col).cast("string")
    return F.when(own.isNull() | (own == ""), place).otherwise(own)


def pending(df: DataFrame, done: DataFrame, key: str = "id") -> DataFrame:
    """Rows of ``df`` whose key is not in ``done``; a null key counts as one key.

    Repeated keys within ``df`` all stay.
    """
    seen = done.select(F.col(key).alias("_done")).distinct()
    return df.join(seen, F.col(key).eqNullSafe(F.col("_done")), "left_anti")


def as_runs(places: DataFrame) -> DataFrame:
    """(src_file, block, lo, hi): places (src_file, src_row) as runs of consecutive rows (gaps and islands).

    Runs are cut where a block of ``BLOCK_ROWS`` rows ends, so that the window
    that finds them never holds more than one block, however large a file is.
    """
    todo = places.select("src_file", "src_row").withColumn("block", F.floor(F.col("src_row") / BLOCK_ROWS))
    island = F.col("src_row") - F.row_number().over(Window.partitionBy("src_file", "block").orderBy("src_row"))
    runs = todo.withColumn("island", island).groupBy("src_file", "block", "island")
    return runs.agg(F.min("src_row").alias("lo"), F.max("src_row").alias("hi")).drop("island")


def pending_intervals(keys: DataFrame, done: DataFrame, key: str = "id") -> DataFrame:
    """(src_file, block, lo, hi): the places of ``keys`` whose key is not in ``done``, as runs (``as_runs``).

    Only keys and places are read and moved.
    """
    return as_runs(pending(keys.select(key, "src_file", "src_row"), done, key))


def _groups(per_file: list, limit: int) -> Iterator[tuple[list[str | None], bool, int]]:
    """(files, split, bytes): files packed into groups whose runs take at most ``limit`` bytes; a larger file alone, to be split."""
    group: list[str | None] = []
    size = 0
    for row in sorted(per_file, key=lambda r: (r["src_file"] is None, r["src_file"] or "")):
        if row["bytes"] > limit:
            yield [row["src_file"]], True, row["bytes"]
            continue
        if group and size + row["bytes"] > limit:
            yield group, False, size
            group, size = [], 0
        group.append(row["src_file"])
        size += row["bytes"]
    if group:
        yield group, False, size


def pending_rows(
    scan: DataFrame, done: DataFrame, key: str = "id", limit: int = BROADCAST_BYTES
) -> DataFrame:
    """``pending`` for rows with large payloads, which never leave their place.

    The keys and places of ``scan`` (no payload) are compared with ``done``;
    what is left becomes runs of rows per file (``pending_intervals``). Only
    files with a run are opened again: a filter on ``src_file`` prunes the
    others before they are read. Rows are then matched to the runs of their
    file and block by a broadcast join, in groups of files whose runs measure at
    most ``limit`` bytes; a single file with more runs is taken in row spans cut
    at block borders (it is then read once per span). No step shuffles the
    payload, at any size.
    """
    seen = stored(done.select(key).distinct())
    return rows_in_runs(scan, stored(pending_intervals(scan, seen, key)), limit)


def rows_in_runs(scan: DataFrame, intervals: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    """The rows of ``scan`` inside the stored runs ``intervals`` (see ``pending_rows``), the payload in place."""
    sizes = intervals.groupBy("src_file").agg(
        F.sum(F.coalesce(F.octet_length("src_file"), F.lit(0)) + INTERVAL_BYTES).alias("bytes")
    )
    parts = []
    for files, split, size in _groups(sizes.collect(), limit):
        chosen = F.col("src_file").isin([f for f in files if f is not None])
        if None in files:
            chosen = chosen | F.col("src_file").isNull()
        spans: list[tuple[int | None, int | None]] = [(None, None)]
        if split:
            pieces = -(-size // max(limit, 1)) * 2
            cuts = intervals.where(chosen).approxQuantile("lo", [i / pieces for i in range(1, pieces)], 0.001)
            bounds = sorted({int(c) // BLOCK_ROWS * BLOCK_ROWS for c in cuts} - {0})
            spans = list(zip([None, *bounds], [*bounds, None], strict=True))
        for low, high in spans:
            rows, runs = chosen, chosen
            if low is not None:
                rows, runs = rows & (F.col("src_row") >= low), runs & (F.col("lo") >= low)
            if high is not None:
                rows, runs = rows & (F.col("src_row") < high), runs & (F.col("lo") < high)
            parts.append(_matched(scan.where(rows), intervals.where(runs)))
    if not parts:
        return scan.where(F.lit(False))
    return reduce(DataFrame.unionByName, parts)


def _matched(rows: DataFrame, runs: DataFrame) -> DataFrame:
    """Rows that lie in one of ``runs``, looked up by file and block in a broadcast table."""
    runs = runs.select(
        F.col("src_file").alias("_file"), F.col("block").alias("_block"), F.col("lo").alias("_lo"), F.col("hi").alias("_hi")
    )
    inside = (
        F.col("src_file").eqNullSafe(F.col("_file"))
        & (F.floor(F.col("src_row") / BLOCK_ROWS) == F.col("_block"))
        & F.col("src_row").between(F.col("_lo"), F.col("_hi"))
    )
    return rows.join(F.broadcast(runs), inside, "left_semi")


def first_of_each(df: DataFrame, key: str = "id") -> DataFrame:
    """The first row of every key in scan order; null keys are all kept."""
    places = (
        df.groupBy(key)
        .agg(F.min(F.struct("src_file", "src_row")).alias("first"))
        .select("first.src_file", "first.src_row")
    )
    firsts = df.where(F.col(key).isNotNull()).join(places, ["src_file", "src_row"], "left_semi")
    return firsts.unionByName(df.where(F.col(key).isNull()))
