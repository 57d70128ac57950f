"""Intake of new files as an available-now stream.

Which keys are new is kept as deduplication state of the stream: only keys
pass through it, and a key comes out the first time it is seen; so does each
file, by its first row. A micro-batch then finds the places of its new keys in
the key column of its own files, and opens these for the payload of the rows at
those places. The whole history of attempts is read once per call, in its first
micro-batch, for rows that runs outside the stream attempted.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence

from pyspark.resource import ResourceProfile
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gleanery.config import CurationConfig
from gleanery.operators.infer import ModelFactory
from gleanery.operators.resume import as_runs, identity, rows_in_runs
from gleanery.plans.jobs import run_filter, run_label
from gleanery.session import Scratch, prepare
from gleanery.sources.scan import check_columns, scan_raw, with_source

# Keyed state lives on the executors' disks, not in their memory, unless the session chose a store.
DEFAULT_STORE = "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider"
DISK_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
STORE_CONF = "spark.sql.streaming.stateStore.providerClass"


def _exists(spark: SparkSession, path: str) -> bool:
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(folder)


def new_keys(arrivals: DataFrame, id_col: str) -> DataFrame:
    """(_is_file, _key): keys, and files with rows, that the stream has not seen before."""
    own = F.struct(F.lit(False).alias("_is_file"), identity(id_col).alias("_key"))
    file = F.struct(F.lit(True).alias("_is_file"), F.col("src_file").alias("_key"))
    seen = with_source(arrivals).select(F.inline(F.when(F.col("src_row") == 0, F.array(own, file)).otherwise(F.array(own))))
    return seen.dropDuplicates(["_is_file", "_key"])


def places_of(keys: DataFrame, rows: DataFrame, id_col: str) -> DataFrame:
    """The places of all ``rows`` with one of ``keys``."""
    at = rows.select(identity(id_col).alias("_key"), "src_file", "src_row")
    return at.join(keys.select("_key"), "_key", "left_semi")


def run_incremental(
    spark: SparkSession,
    cfg: CurationConfig,
    filter_model: ModelFactory,
    label_model: ModelFactory | None = None,
    *,
    schema: T.StructType | None = None,
    max_files: int | None = None,
    text_cols: Sequence[str] = (),
    sleep: Callable[[float], None] = time.sleep,
    profile: ResourceProfile | None = None,
) -> int:
    """Judge the files that came since the last call; return the number of micro-batches.

    A micro-batch is one run, named by query and batch.  If Spark repeats it,
    the ledger has it either finished, or judged with only the derived tables
    to write, or not at all.  With ``label_model`` the rows kept are labelled
    after the stream has caught up.  ``num_batches`` has to be unset: the stream
    takes a file for good, so rows behind a cap would never be judged; bound
    micro-batches with ``max_files``. A key is taken once by the stream: rows
    that failed are tried again by ``run_filter`` with ``retry_failed``, not by
    later micro-batches. ``profile`` asks for resources for the model's tasks.
    """
    if cfg.num_batches:
        raise ValueError("num_batches caps single runs; bound incremental intake with max_files")
    prepare(spark)
    if spark.conf.get(STORE_CONF, DEFAULT_STORE) == DEFAULT_STORE:
        spark.conf.set(STORE_CONF, DISK_STORE)
    if schema is None:
        known = scan_raw(spark, cfg.raw_dir, cfg.id_col, cfg.bytes_col).drop("src_file", "src_row")
        schema = known.schema
    reader = spark.readStream.schema(schema).option("pathGlobFilter", "*.parquet")
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    arrivals = reader.parquet(cfg.raw_dir)
    check_columns(arrivals, cfg.id_col, cfg.bytes_col)
    fresh = new_keys(arrivals, cfg.id_col)

    # A stream that an earlier version began starts anew: what it judged is in the history of attempts.
    restarted = _exists(spark, f"{cfg.root}/checkpoints/intake-keyed")
    batches: list[int] = []

    def judge(found: DataFrame, batch_id: int) -> None:
        session = found.sparkSession
        query = session.sparkContext.getLocalProperty("sql.streaming.queryId") or "stream"
        history = restarted or not batches
        batches.append(batch_id)
        with Scratch(session) as tmp:
            found = tmp.store(found)
            files = [row["_key"] for row in found.where("_is_file").collect()]
            if not files:
                return
            rows = with_source(session.read.schema(schema).parquet(*files))
            runs = tmp.store(as_runs(places_of(found.where("NOT _is_file"), rows, cfg.id_col)))
            if runs.isEmpty():
                return
            rows = rows_in_runs(rows, runs)
            run_filter(
                session,
                cfg,
                filter_model,
                raw=rows,
                run_id=f"{query}-{batch_id:06d}",
                text_cols=text_cols,
                sleep=sleep,
                profile=profile,
                check_history=history,
            )

    query = (
        fresh.writeStream.foreachBatch(judge)
        .option("checkpointLocation", f"{cfg.root}/checkpoints/intake-distinct")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    if label_model is not None:
        run_label(spark, cfg, label_model, text_cols=text_cols, sleep=sleep, profile=profile)
    return len(batches)
