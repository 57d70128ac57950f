"""The append-only table of runs."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gleanery.config import CurationConfig
from gleanery.schemas import LEDGER
from gleanery.session import read_or_empty

JUDGED = "judged"
DONE = "done"


@dataclass(frozen=True)
class Run:
    """One run of one stage; ``first_shard`` lets its shards be written again."""

    run_id: str
    run_seq: int
    stage: str
    total: int
    kept: int
    skipped: int
    errors: int
    first_shard: int


def read_ledger(spark: SparkSession, cfg: CurationConfig) -> DataFrame:
    return read_or_empty(spark, cfg.ledger_dir, LEDGER)


def record(spark: SparkSession, cfg: CurationConfig, run: Run, status: str) -> None:
    row = {**vars(run), "status": status}
    values = [F.lit(row[f.name]).cast(f.dataType).alias(f.name) for f in LEDGER.fields]
    spark.range(1, numPartitions=1).select(*values).write.mode("append").parquet(cfg.ledger_dir)


def runs(spark: SparkSession, cfg: CurationConfig, stage: str) -> dict[str, dict[str, Run]]:
    """``{run_id: {status: run}}`` of a stage; two rows per run."""
    found: dict[str, dict[str, Run]] = {}
    for row in read_ledger(spark, cfg).where(F.col("stage") == stage).collect():
        values = row.asDict()
        status = values.pop("status")
        found.setdefault(row["run_id"], {})[status] = Run(**values)
    return found


def ledger_totals(ledger: DataFrame) -> DataFrame:
    """Counters of every finished run with their running totals by stage."""
    so_far = (
        Window.partitionBy("stage")
        .orderBy("run_seq")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    counters = ("total", "kept", "skipped", "errors")
    return ledger.where(F.col("status") == DONE).select(
        "stage",
        "run_id",
        "run_seq",
        *counters,
        *[F.sum(c).over(so_far).alias(f"cum_{c}") for c in counters],
    )
