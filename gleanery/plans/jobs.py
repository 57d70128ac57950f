"""The filter and label jobs.

A job writes what the model said once, to an outcome table, and derives shards,
quarantine and statistics from that table, so that no row is judged twice.  The
ledger says how far a run came:

- not in the ledger: the run counts as never started and is judged anew (a run
  that found no rows leaves no entry),
- ``judged``: its outcomes are complete, only the derived tables are written,
- ``done``: nothing is left to do.
"""

from __future__ import annotations

import logging
import time
from collections.abc import Callable, Sequence
from datetime import datetime, timezone

from pyspark.resource import ResourceProfile
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanery.config import CurationConfig
from gleanery.functions.text import parse_verdict
from gleanery.operators.infer import ModelFactory, RetryPolicy, infer
from gleanery.operators.labels import parse_labels
from gleanery.operators.position import cap, with_batch
from gleanery.operators.project import (
    image_metadata,
    normalize,
    payload_error,
    request_messages,
    to_filter_output,
    to_label_output,
)
from gleanery.operators.resume import first_of_each, identity, pending_rows
from gleanery.plans.ledger import DONE, JUDGED, Run, read_ledger, record, runs
from gleanery.plans.reports import run_stats
from gleanery.schemas import ATTEMPTS, FILTER_OUTPUT, LABEL_OUTPUT
from gleanery.session import prepare, read_or_empty
from gleanery.sinks.shards import next_shard, read_shards, write_shards
from gleanery.sinks.tables import write_quarantine
from gleanery.sources.scan import scan_raw

log = logging.getLogger(__name__)

_SCHEMAS = {"filter": FILTER_OUTPUT, "label": LABEL_OUTPUT}


def _retry(cfg: CurationConfig, sleep: Callable[[float], None]) -> RetryPolicy:
    return RetryPolicy(cfg.max_attempts, cfg.backoff_base, cfg.backoff_max, sleep)


def _attempted(spark: SparkSession, cfg: CurationConfig, stage: str, judged: Sequence[str]) -> DataFrame:
    rows = read_or_empty(spark, cfg.attempts_dir(stage), ATTEMPTS)
    return rows.where(F.col("run_id").isin(list(judged)))


def attempts(spark: SparkSession, cfg: CurationConfig, stage: str) -> DataFrame:
    """Rows that judged runs of a stage attempted, with ``run_seq``; no payloads."""
    rows = _attempted(spark, cfg, stage, list(runs(spark, cfg, stage)))
    order = read_ledger(spark, cfg).where((F.col("stage") == stage) & (F.col("status") == JUDGED))
    return rows.join(order.select("run_id", "run_seq"), "run_id")


def _todo(
    spark: SparkSession,
    cfg: CurationConfig,
    stage: str,
    judged: Sequence[str],
    rows: DataFrame,
    key: str,
    history: bool = True,
) -> DataFrame:
    """Leave out what the judged runs attempted (unless the caller did so already: ``history=False``)."""
    if judged and history:
        done = _attempted(spark, cfg, stage, judged)
        if cfg.retry_failed:
            done = done.where(F.col("status") != "error")
        rows = pending_rows(rows, done.select(identity("id").alias(key)), key)
    return first_of_each(rows, key) if cfg.dedupe_ids else rows


def _judge(
    spark: SparkSession,
    cfg: CurationConfig,
    judged: Sequence[str],
    model_factory: ModelFactory,
    raw: DataFrame,
    text_cols: Sequence[str],
    sleep: Callable[[float], None],
    profile: ResourceProfile | None,
    history: bool = True,
) -> DataFrame:
    """Outcomes of the filter stage; everything cheap happens before the model."""
    path = ["file_path"] if "file_path" in raw.columns else []
    needed = list(dict.fromkeys([cfg.id_col, cfg.bytes_col, *path, "src_file", "src_row"]))
    rows = raw.select(*needed, identity(cfg.id_col).alias("_key"))
    rows = cap(_todo(spark, cfg, "filter", judged, rows, "_key", history), cfg.batch_size, cfg.num_batches)
    now = F.lit(datetime.now(timezone.utc))
    probed = image_metadata(
        normalize(rows, cfg.id_col, cfg.bytes_col, now), mode=cfg.format_mode, decoder=cfg.decoder
    )
    probed = probed.withColumn("payload_error", payload_error("file_name"))
    request = request_messages(
        cfg.filter_prompts.system, cfg.filter_prompts.user, ["image_bytes"], text_cols
    )
    asked = infer(
        probed,
        model_factory,
        F.when(F.col("payload_error").isNull(), request),
        retry=_retry(cfg, sleep),
        call_rows=cfg.call_rows,
        profile=profile,
    )
    answered = F.col("answer").isNotNull()
    keep = parse_verdict(F.col("answer"))
    outcome = asked.withColumns(
        {
            "filter_result": F.when(answered, F.when(keep, F.lit("YES")).otherwise(F.lit("NO"))),
            "status": F.when(~answered, F.lit("error"))
            .when(keep, F.lit("kept"))
            .otherwise(F.lit("skipped")),
            "error": F.coalesce("payload_error", "model_error"),
        }
    )
    return to_filter_output(
        outcome, "source_id", "status", "attempts", "src_file", "src_row", processed_at=now
    )


def _label(
    spark: SparkSession,
    cfg: CurationConfig,
    judged: Sequence[str],
    model_factory: ModelFactory,
    kept: DataFrame,
    text_cols: Sequence[str],
    sleep: Callable[[float], None],
    profile: ResourceProfile | None,
) -> DataFrame:
    """Outcomes of the label stage."""
    rows = _todo(spark, cfg, "label", judged, kept, "id")
    # The filter stage named a format for every payload whose header it could read.
    rows = rows.drop("error", "processed_at").withColumn("decodable", F.col("image_format").isNotNull())
    rows = rows.withColumn("payload_error", payload_error())
    request = request_messages(cfg.label_prompts.system, cfg.label_prompts.user, ["image_bytes"], text_cols)
    asked = infer(
        rows,
        model_factory,
        F.when(F.col("payload_error").isNull(), request),
        retry=_retry(cfg, sleep),
        call_rows=cfg.call_rows,
        profile=profile,
    )
    parsed = parse_labels(asked)
    refused = F.coalesce("payload_error", "rejected")
    outcome = parsed.withColumns(
        {
            "status": F.when(refused.isNotNull(), F.lit("error"))
            .when(F.col("model_error").isNotNull(), F.lit("model_error"))
            .when(F.col("error").isNotNull(), F.lit("parse_error"))
            .otherwise(F.lit("labelled")),
            "error": F.coalesce(refused, "model_error", "error"),
            "source_id": F.col("id"),
        }
    )
    now = F.lit(datetime.now(timezone.utc))
    return to_label_output(
        outcome, "source_id", "status", "attempts", "src_file", "src_row", "shard", processed_at=now
    )


def _finish(spark: SparkSession, cfg: CurationConfig, run: Run) -> None:
    """Write shards and quarantine of a judged run; safe to repeat."""
    outcomes = spark.read.parquet(f"{cfg.outcomes_dir(run.stage)}/run_id={run.run_id}")
    failed = F.col("status") == "error"
    if run.total > run.errors:
        write_shards(
            outcomes.where(~failed).drop("shard"),
            cfg.output_dir(run.stage),
            _SCHEMAS[run.stage],
            cfg.rows_per_shard,
            cfg.compression,
            start=run.first_shard,
            one_file=cfg.one_file_per_shard,
            ranges=cfg.shard_ranges,
        )
    if run.errors:
        rejected = outcomes.where(failed).select(
            "id", "error", F.lit(run.stage).alias("stage"), F.lit(run.run_id).alias("run_id")
        )
        write_quarantine(rejected, cfg.quarantine_dir)
    record(spark, cfg, run, DONE)
    if not cfg.keep_outcomes:
        # Rows and payloads are in the shards now; only the schema stays here.
        spark.createDataFrame([], outcomes.schema).write.mode("overwrite").parquet(
            f"{cfg.outcomes_dir(run.stage)}/run_id={run.run_id}"
        )


def _run(
    spark: SparkSession,
    cfg: CurationConfig,
    stage: str,
    judge: Callable[[Sequence[str]], DataFrame],
    run_id: str | None,
) -> Run:
    known = runs(spark, cfg, stage)
    for states in known.values():
        if DONE not in states:
            log.warning("finishing run %s, which was judged before", states[JUDGED].run_id)
            _finish(spark, cfg, states[JUDGED])
    if run_id in known:
        return known[run_id][JUDGED]
    run_seq = 1 + max((s[JUDGED].run_seq for s in known.values()), default=0)
    run_id = run_id or f"{stage}-{run_seq:06d}"
    outcomes_path = f"{cfg.outcomes_dir(stage)}/run_id={run_id}"
    attempts_path = f"{cfg.attempts_dir(stage)}/run_id={run_id}"

    judge(list(known)).write.mode("overwrite").option("compression", cfg.compression).parquet(outcomes_path)

    keys = spark.read.parquet(outcomes_path)
    if stage == "filter":
        places = with_batch(
            keys.select(F.col("source_id").alias("id"), "status", "error", "src_file", "src_row"), cfg.batch_size
        )
    else:
        places = keys.withColumns({"id": F.col("source_id"), "batch": F.col("shard").cast("bigint")})
    names = [name for name in ATTEMPTS.names if name != "run_id"]
    places.select(*names).write.mode("overwrite").parquet(attempts_path)

    stats = run_stats(spark.read.parquet(attempts_path), stage).first()
    run = Run(
        run_id,
        run_seq,
        stage,
        stats["total"],
        stats["kept"],
        stats["skipped"],
        stats["errors"],
        next_shard(spark, cfg.output_dir(stage)) if stats["total"] else 0,
    )
    if not run.total:
        log.info("%s: nothing to process", stage)
        return run
    record(spark, cfg, run, JUDGED)
    _finish(spark, cfg, run)
    log.info("%s run %s: %s", stage, run_id, stats.asDict())
    return run


def run_filter(
    spark: SparkSession,
    cfg: CurationConfig,
    model_factory: ModelFactory,
    *,
    raw: DataFrame | None = None,
    run_id: str | None = None,
    text_cols: Sequence[str] = (),
    sleep: Callable[[float], None] = time.sleep,
    profile: ResourceProfile | None = None,
    check_history: bool = True,
) -> Run:
    """Judge the raw rows that no earlier run attempted, and write all verdicts.

    ``raw`` replaces the scan of ``cfg.raw_dir``; ``text_cols`` names columns of
    the normalised record that are sent along with the image.
    ``check_history=False`` is for callers that left out attempted rows already.
    """
    prepare(spark)
    rows = scan_raw(spark, cfg.raw_dir, cfg.id_col, cfg.bytes_col) if raw is None else raw
    return _run(
        spark,
        cfg,
        "filter",
        lambda judged: _judge(spark, cfg, judged, model_factory, rows, text_cols, sleep, profile, check_history),
        run_id,
    )


def run_label(
    spark: SparkSession,
    cfg: CurationConfig,
    model_factory: ModelFactory,
    *,
    run_id: str | None = None,
    text_cols: Sequence[str] = (),
    sleep: Callable[[float], None] = time.sleep,
    profile: ResourceProfile | None = None,
) -> Run | None:
    """Label the rows that the filter stage kept; without such a stage, do nothing."""
    prepare(spark)
    try:
        stage = read_shards(spark, cfg.output_dir("filter"), FILTER_OUTPUT)
    except FileNotFoundError:
        log.warning("no output of the filter stage in %s, run that first", cfg.output_dir("filter"))
        return None
    kept = stage.where(F.col("filter_result") == "YES")
    return _run(
        spark,
        cfg,
        "label",
        lambda judged: _label(spark, cfg, judged, model_factory, kept, text_cols, sleep, profile),
        run_id,
    )


def run_stages(
    spark: SparkSession,
    cfg: CurationConfig,
    filter_model: ModelFactory,
    label_model: ModelFactory | None = None,
    stage: str = "all",
    **options,
) -> dict[str, Run | None]:
    """One stage or both; one model serves both unless a second is given."""
    if stage not in ("all", "filter", "label"):
        raise ValueError(f"unknown stage {stage!r}")
    report: dict[str, Run | None] = {}
    if stage in ("all", "filter"):
        report["filter"] = run_filter(spark, cfg, filter_model, **options)
    if stage in ("all", "label"):
        report["label"] = run_label(spark, cfg, label_model or filter_model, **options)
    return report
