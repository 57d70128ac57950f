"""Statistics over runs, shards, labels and payloads."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleanery.operators.labels import vocab_flags
from gleanery.operators.position import running_totals

COUNTERS = ("total", "kept", "skipped", "errors")
_BATCHES_PER_RANGE = 10_000


def _counters(stage: str) -> list:
    status = F.col("status")
    failed = status == "error"
    if stage == "filter":
        kept, skipped = status == "kept", status == "skipped"
    else:  # every row that was written, also with an error in it
        kept, skipped = ~failed, F.lit(False)
    return [
        F.count("*").alias("total"),
        F.count_if(kept).alias("kept"),
        F.count_if(skipped).alias("skipped"),
        F.count_if(failed).alias("errors"),
    ]


def run_stats(outcomes: DataFrame, stage: str) -> DataFrame:
    """``total, kept, skipped, errors`` of one stage; for labels also ``labelled_ok``."""
    extra = [] if stage == "filter" else [F.count_if(F.col("status") == "labelled").alias("labelled_ok")]
    return outcomes.agg(*_counters(stage), *extra)


def progress(attempts: DataFrame, stage: str) -> DataFrame:
    """Counters per batch and their running totals over all runs of a stage.

    Needs ``run_seq``, ``batch`` and ``status``.
    """
    batches = attempts.groupBy("run_seq", "batch").agg(*_counters(stage)).withColumn("stage", F.lit(stage))
    totals = running_totals(
        batches,
        "stage",
        ("run_seq", "batch"),
        COUNTERS,
        F.floor(F.col("batch") / F.lit(_BATCHES_PER_RANGE)),
    )
    return totals.select("stage", "run_seq", "batch", *COUNTERS, *[f"cum_{c}" for c in COUNTERS])


def shard_report(shards: DataFrame) -> DataFrame:
    """Rows per shard."""
    return shards.groupBy("shard").agg(F.count("*").alias("rows"))


def label_report(labels: DataFrame) -> DataFrame:
    """Counts by category and mood, with unknown words and errors."""
    return (
        vocab_flags(labels)
        .groupBy("category", "mood")
        .agg(
            F.count("*").alias("rows"),
            F.count_if(~F.col("category_known")).alias("unknown_category"),
            F.count_if(~F.col("mood_known")).alias("unknown_mood"),
            F.count_if(F.col("error").isNotNull()).alias("errors"),
            F.avg(F.col("error").isNotNull().cast("int")).alias("error_rate"),
        )
    )


def image_inventory(images: DataFrame, bytes_col: str = "image_bytes") -> DataFrame:
    """Payload counts and sizes per format; undecodable ones have format NULL."""
    size = F.octet_length(bytes_col).cast("bigint")
    return images.groupBy("image_format").agg(
        F.count("*").alias("rows"),
        F.count_if(~F.col("decodable")).alias("undecodable"),
        F.count_if(F.coalesce(size, F.lit(0)) == 0).alias("without_bytes"),
        F.min(size).alias("min_bytes"),
        F.max(size).alias("max_bytes"),
        F.avg(size).alias("avg_bytes"),
    )
