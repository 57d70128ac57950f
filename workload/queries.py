"""One query per operator."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gleanery.config import CurationConfig
from gleanery.functions import json_labels as J
from gleanery.functions.text import parse_verdict, py_strip, strip_fences
from gleanery.operators.infer import RetryPolicy, infer
from gleanery.operators.labels import flatten_label, parse_labels, vocab_flags
from gleanery.operators.position import cap, with_batch, with_position, with_shard
from gleanery.operators.project import (
    build_request,
    conform,
    image_metadata,
    normalize,
    payload_error,
    split_verdict,
    to_filter_output,
    to_label_output,
)
from gleanery.operators.resume import pending_rows
from gleanery.operators.union import union_by_name
from gleanery.plans.jobs import attempts, run_filter, run_stages
from gleanery.plans.ledger import ledger_totals, read_ledger
from gleanery.plans.reports import image_inventory, label_report, progress, run_stats, shard_report
from gleanery.session import prepare, scratch_dir
from gleanery.sinks.shards import merge_shards, write_shards
from gleanery.sinks.tables import append_table, publish, read_conformed, write_table
from gleanery.sources.files import file_manifest, load_selected, select_files
from gleanery.sources.scan import extract_bytes, read_stage, read_table, scan_raw, with_source
from gleanery.streaming.incremental import run_incremental
from workload import fixtures as X
from workload.models import filter_model, label_model, no_wait, text_model

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

ROWS_PER_SHARD = 100
BATCH_SIZE = 10
FIRST_RUN_BATCHES = 7


def query(name: str) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn

    return register


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _sql(spark: SparkSession, sf_dir: str, text: str) -> DataFrame:
    prepare(spark)
    _table(spark, sf_dir, "documents").createOrReplaceTempView("documents")
    return spark.sql(text)


def _payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sql(spark, sf_dir, X.payloads(X.SPARK_BYTES))


def _label_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sql(spark, sf_dir, X.LABEL_ANSWERS)


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return with_source(_table(spark, sf_dir, "documents"))


# ---- scans ----


@query("scan_raw")
def scan_raw_records(spark, sf_dir):
    rows = scan_raw(spark, f"{sf_dir}/documents.parquet", "doc_id", "text")
    return rows.select(
        F.col("doc_id").cast("string").alias("id"),
        F.md5("text").alias("payload_md5"),
        "src_row",
        F.regexp_extract("src_file", "[^/]+$", 0).alias("file_name"),
    )


@query("extract_bytes")
def extract_payload(spark, sf_dir):
    cells = _table(spark, sf_dir, "documents").selectExpr(
        "cast(doc_id AS string) AS id",
        "encode(text, 'UTF-8') AS plain",
        "named_struct('bytes', CASE n_chars % 3 WHEN 0 THEN NULL WHEN 1 THEN unhex('') ELSE encode(text, 'UTF-8') END,"
        " 'path', source, 'data', encode(lang, 'UTF-8')) AS both",
        "named_struct('data', encode(text, 'UTF-8')) AS data_only",
        "array(cast(doc_id % 128 AS tinyint), cast(-1 - n_chars % 100 AS tinyint), 0Y) AS small",
        "text AS characters",
    )
    names = [c for c in cells.columns if c != "id"]
    got = {c: extract_bytes(F.col(c), cells.schema[c].dataType) for c in names}
    return cells.select("id", *[F.md5(got[c]).alias(f"{c}_md5") for c in names])


@query("extract_bytes_floats")
def extract_from_floats(spark, sf_dir):
    vectors = _table(spark, sf_dir, "embeddings")
    payload = extract_bytes(F.col("embedding"), vectors.schema["embedding"].dataType)
    return vectors.select("vec_id", payload.isNull().alias("no_payload"))


@query("read_pushdown")
def read_pushdown(spark, sf_dir):
    return read_table(
        spark,
        f"{sf_dir}/lineitem.parquet",
        ["l_orderkey", "l_linenumber", "l_extendedprice"],
        [[("l_quantity", ">", 30.0), ("l_returnflag", "=", "R")], [("l_discount", ">=", 0.09)]],
    )


def _stage_table(spark, sf_dir):
    rows = image_metadata(_payloads(spark, sf_dir).withColumnRenamed("data", "image_bytes"))
    rows = rows.withColumn("digit", F.left(F.md5("image_bytes"), F.lit(1)))
    verdict = F.when(parse_verdict(F.expr(X.VERDICT_OF_DIGIT)), F.lit("YES")).otherwise(F.lit("no"))
    return rows.withColumns({"file_name": F.col("id"), "filter_result": verdict})


def _stored_stage(spark, sf_dir):
    path = scratch_dir(spark)
    write_table(to_filter_output(_stage_table(spark, sf_dir)), path)
    return path


@query("read_stage_yes")
def read_stage_yes(spark, sf_dir):
    rows = read_stage(spark, _stored_stage(spark, sf_dir), ["id", "image_bytes", "filter_result"])
    return rows.select("id", "filter_result", F.md5("image_bytes").alias("image_md5"))


@query("read_stage_all")
def read_stage_all(spark, sf_dir):
    rows = read_stage(spark, _stored_stage(spark, sf_dir), ["id", "image_bytes", "filter_result"], None)
    return rows.select("id", "filter_result", F.md5("image_bytes").alias("image_md5"))


# ---- files ----

_DOCUMENT = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType())])


def _sharded_documents(spark, sf_dir):
    path = scratch_dir(spark)
    write_shards(_documents(spark, sf_dir), path, _DOCUMENT, ROWS_PER_SHARD)
    return path


def _shard_dirs(manifest):
    return manifest.select(
        F.regexp_extract("rel_path", r"(shard=\d+)/", 1).alias("shard_dir"),
        (F.col("length") > 0).alias("has_bytes"),
    )


@query("file_manifest")
def manifest_of_shards(spark, sf_dir):
    return _shard_dirs(file_manifest(spark, _sharded_documents(spark, sf_dir), "*.parquet", recursive=True))


@query("select_files")
def select_by_pattern(spark, sf_dir):
    names = _sql(spark, sf_dir, X.FILE_NAMES)
    return select_files(
        names, "data/en", ignore=["*-1*.parquet"], file_filter=lambda rel: rel.endswith(".parquet")
    )


@query("load_selected")
def load_by_pattern(spark, sf_dir):
    path = _sharded_documents(spark, sf_dir)
    files = file_manifest(spark, path, "*.parquet", recursive=True)
    rows = load_selected(spark, select_files(files, "", allow=["shard=*[02468]/*"]), path)
    return rows.select("doc_id", F.md5("text").alias("text_md5"), F.col("shard").cast("bigint").alias("shard"))


# ---- projections ----


@query("normalize_input")
def normalize_input(spark, sf_dir):
    rows = normalize(_payloads(spark, sf_dir), "doc_id", "data")
    return rows.select("id", "file_name", "file_path", F.md5("image_bytes").alias("image_md5"))


@query("conform")
def conform_columns(spark, sf_dir):
    schema = T.StructType(
        [
            T.StructField("doc_id", T.StringType()),
            T.StructField("score", T.DoubleType()),
            T.StructField("n_chars", T.IntegerType()),
            T.StructField("lang", T.StringType()),
        ]
    )
    return conform(_table(spark, sf_dir, "documents"), schema)


@query("filter_output")
def filter_output(spark, sf_dir):
    rows = to_filter_output(_stage_table(spark, sf_dir))
    return rows.drop("processed_at").withColumn("image_bytes", F.md5("image_bytes"))


def _labelled(spark, sf_dir):
    stage = to_filter_output(_stage_table(spark, sf_dir)).drop("error").alias("stage")
    return stage.join(_label_answers(spark, sf_dir), "id")


@query("label_output")
def label_output(spark, sf_dir):
    rows = parse_labels(_labelled(spark, sf_dir)).where("rejected IS NULL")
    shaped = to_label_output(rows)
    return shaped.drop("processed_at").withColumns(
        {
            "image_bytes": F.md5("image_bytes"),
            "label_json": F.md5("label_json"),
            "description": F.md5("description"),
        }
    )


@query("image_metadata")
def image_headers(spark, sf_dir):
    rows = image_metadata(_payloads(spark, sf_dir).withColumnRenamed("data", "image_bytes"))
    return rows.select("id", "width", "height", "image_format", "decodable")


@query("image_metadata_one_format")
def image_headers_one_format(spark, sf_dir):
    rows = image_metadata(_payloads(spark, sf_dir).withColumnRenamed("data", "image_bytes"), mode="reference")
    return rows.select("id", "image_format")


@query("image_inventory")
def image_inventory_report(spark, sf_dir):
    rows = image_inventory(image_metadata(_payloads(spark, sf_dir).withColumnRenamed("data", "image_bytes")))
    return rows.withColumn("avg_bytes", F.round("avg_bytes", 3))


@query("build_request")
def build_requests(spark, sf_dir):
    rows = build_request(
        _payloads(spark, sf_dir).join(
            _table(spark, sf_dir, "documents").selectExpr("doc_id", "text", "nullif(lang, 'de') AS lang"), "doc_id"
        ),
        "You judge.",
        "Keep it?",
        image_cols=["data"],
        text_cols=["lang", "text"],
    )
    parts = F.col("messages")[1]["content"]
    return rows.select(
        "id",
        F.array_join(F.transform("messages", lambda m: m["role"]), ",").alias("roles"),
        F.col("messages")[0]["content"][0]["text"].alias("system_text"),
        F.array_join(F.transform(parts, lambda p: p["type"]), ",").alias("part_types"),
        F.md5(F.array_join(F.transform(parts, lambda p: p["text"]), "|")).alias("texts_md5"),
        F.md5(parts[0]["image"]).alias("image_md5"),
    )


# ---- predicates and text ----


@query("py_strip")
def strip_unicode(spark, sf_dir):
    padded = F.concat(
        F.expr("decode(unhex('C2A0E2808320091C1F0A'), 'UTF-8')"),
        F.col("text"),
        F.expr("decode(unhex('C285E38080E280A80D'), 'UTF-8')"),
    )
    return _table(spark, sf_dir, "documents").select("doc_id", F.md5(py_strip(padded)).alias("stripped_md5"))


@query("parse_verdict")
def parse_verdicts(spark, sf_dir):
    return _sql(spark, sf_dir, X.VERDICT_ANSWERS).select("id", parse_verdict(F.col("answer")).alias("keep"))


@query("verdict_routing")
def verdict_routing(spark, sf_dir):
    kept, rejected = split_verdict(to_filter_output(_stage_table(spark, sf_dir)))
    routes = kept.select("id", F.lit("kept").alias("route"), F.col("image_bytes").isNotNull().alias("has_bytes"))
    return routes.unionAll(
        rejected.select("id", F.lit("rejected").alias("route"), F.col("image_bytes").isNotNull().alias("has_bytes"))
    )


@query("unusable_payload")
def unusable_payload(spark, sf_dir):
    rows = image_metadata(_payloads(spark, sf_dir).withColumnRenamed("data", "image_bytes"))
    return rows.select("id", payload_error().alias("error")).where("error IS NOT NULL")


@query("vocab_flags")
def vocabulary_flags(spark, sf_dir):
    rows = vocab_flags(parse_labels(_label_answers(spark, sf_dir)))
    return rows.select("id", "category", "mood", "category_known", "mood_known")


@query("strip_fences")
def fences_removed(spark, sf_dir):
    return _label_answers(spark, sf_dir).select("id", F.md5(strip_fences(F.col("answer"))).alias("cleaned_md5"))


@query("strict_json")
def strict_json_values(spark, sf_dir):
    value = J.strict_json(strip_fences(F.col("answer")))
    rows = _label_answers(spark, sf_dir).withColumn("value", value)
    return rows.select(
        "id",
        F.col("value").isNotNull().alias("is_json"),
        F.try_variant_get("value", "$.category", "string").alias("category"),
    )


@query("json_fallback")
def json_fallback(spark, sf_dir):
    rows = _label_answers(spark, sf_dir).select("id", strip_fences(F.col("answer")).alias("cleaned"))
    rows = rows.withColumn("fragment", J.embedded_object(F.col("cleaned")))
    return rows.select(
        "id",
        F.md5("fragment").alias("fragment_md5"),
        (J.strict_json(F.col("cleaned")).isNull() & J.strict_json(F.col("fragment")).isNotNull()).alias("rescued"),
    )


@query("label_errors")
def label_errors(spark, sf_dir):
    return parse_labels(_label_answers(spark, sf_dir)).select("id", "error").where("error IS NOT NULL")


@query("flatten_label")
def flatten_labels(spark, sf_dir):
    rows = _label_answers(spark, sf_dir).withColumn("document", J.answer_document(F.col("answer")))
    rows = flatten_label(rows.where(J.is_object(F.col("document"))))
    return rows.select(
        "id",
        "category",
        "subcategory",
        F.md5("description").alias("description_md5"),
        "landmark",
        "city",
        "mood",
        "is_professional",
        "has_text_overlay",
        F.md5("answer").alias("label_json_md5"),
    )


@query("label_non_object")
def label_non_object(spark, sf_dir):
    rows = parse_labels(_label_answers(spark, sf_dir))
    return rows.select("id", "rejected").where("rejected IS NOT NULL")


# ---- resume and positions ----


def _pending(spark, sf_dir):
    return pending_rows(_documents(spark, sf_dir), _table(spark, sf_dir, "labels"), "doc_id")


@query("resume_anti_join")
def resume_anti_join(spark, sf_dir):
    return _pending(spark, sf_dir).select("doc_id", F.md5("text").alias("text_md5"))


@query("capped_intake")
def capped_intake(spark, sf_dir):
    rows = cap(_pending(spark, sf_dir), BATCH_SIZE, FIRST_RUN_BATCHES)
    return rows.select("doc_id", F.md5("text").alias("text_md5"))


@query("batch_index")
def batch_index(spark, sf_dir):
    return with_batch(_pending(spark, sf_dir).select("doc_id", "src_file", "src_row"), BATCH_SIZE).select(
        "doc_id", "pos", "batch"
    )


@query("scan_position")
def scan_position(spark, sf_dir):
    rows = with_source(_table(spark, sf_dir, "lineitem")).where("l_quantity > 10")
    return with_position(rows.select("l_orderkey", "l_linenumber", "src_file", "src_row")).select(
        "l_orderkey", "l_linenumber", "src_row", "pos"
    )


@query("shard_assignment")
def shard_assignment(spark, sf_dir):
    rows = with_shard(_pending(spark, sf_dir).select("doc_id", "src_file", "src_row"), ROWS_PER_SHARD, start=5)
    return rows.select("doc_id", "shard", "shard_name")


# ---- model ----


def _asked(spark, sf_dir, fail):
    docs = _table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("id"), "text")
    rows = build_request(docs, "You judge.", "Keep it?", text_cols=["text"])
    return infer(rows, text_model(fail), "messages", retry=RetryPolicy(sleep=no_wait())).select(
        "id", "answer", "model_error", "attempts"
    )


@query("infer_stub")
def infer_stub(spark, sf_dir):
    return _asked(spark, sf_dir, False)


@query("infer_errors")
def infer_errors(spark, sf_dir):
    return _asked(spark, sf_dir, True)


# ---- sinks ----


@query("write_shards")
def write_numbered_shards(spark, sf_dir):
    path = _sharded_documents(spark, sf_dir)
    write_shards(_documents(spark, sf_dir), path, _DOCUMENT, ROWS_PER_SHARD)
    return spark.read.parquet(path).select(
        "doc_id", F.md5("text").alias("text_md5"), F.col("shard").cast("bigint").alias("shard")
    )


@query("shard_report")
def shard_rows(spark, sf_dir):
    report = shard_report(spark.read.parquet(_sharded_documents(spark, sf_dir)))
    return report.select(F.col("shard").cast("bigint").alias("shard"), "rows")


@query("write_roundtrip")
def write_roundtrip(spark, sf_dir):
    path = scratch_dir(spark)
    write_table(_table(spark, sf_dir, "labels").withColumnRenamed("quality", "text"), path)
    write_table(_table(spark, sf_dir, "documents"), path, _DOCUMENT, "zstd")
    return read_table(spark, path).select("doc_id", F.md5("text").alias("text_md5"))


@query("append_table")
def append_rows(spark, sf_dir):
    path = scratch_dir(spark)
    schema = T.StructType(
        [
            T.StructField("doc_id", T.LongType()),
            T.StructField("lang", T.StringType()),
            T.StructField("quality", T.IntegerType()),
        ]
    )
    append_table(_table(spark, sf_dir, "documents"), path, schema)
    append_table(_table(spark, sf_dir, "labels"), path, schema, "gzip")
    return read_conformed(spark, path, schema)


@query("merge_shards")
def merge_into_files(spark, sf_dir):
    merged = scratch_dir(spark)
    merge_shards(spark, _sharded_documents(spark, sf_dir), merged)
    return spark.read.parquet(merged).select("doc_id", F.md5("text").alias("text_md5"))


@query("publish_manifest")
def publish_manifest(spark, sf_dir):
    source, dest = _sharded_documents(spark, sf_dir), scratch_dir(spark)
    files = publish(
        source, dest, spark, file_filter=lambda rel: ~rel.startswith("shard=00001/"), partition_by=["shard"]
    )
    return files.select(
        F.regexp_extract("rel_path", r"shard=(\d+)/", 1).cast("bigint").alias("shard")
    ).distinct()


@query("union_by_name")
def union_tables(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents").select("doc_id", "lang")
    return union_by_name(docs, _table(spark, sf_dir, "labels"), docs.select("lang"))


# ---- jobs ----


def _raw_images(spark, sf_dir):
    """Payloads as raw Parquet files whose order is that of the documents."""
    path, files = scratch_dir(spark), _partitions(spark)
    rows = _payloads(spark, sf_dir).select("doc_id", "data", "file_path")
    rows.repartitionByRange(files, "doc_id").sortWithinPartitions("doc_id").write.parquet(path)
    return path


def _partitions(spark):
    return spark.sparkContext.defaultParallelism


_job_roots: dict[tuple[str, str], CurationConfig] = {}


def _config(spark, raw, **settings):
    return CurationConfig(
        root=scratch_dir(spark),
        input_dir=raw,
        id_col="doc_id",
        batch_size=BATCH_SIZE,
        rows_per_shard=ROWS_PER_SHARD,
        **settings,
    )


def _two_runs(spark, sf_dir):
    """Both stages, first over a few batches and then over the rest.

    The tables are written once per application and input, and shared by the
    queries that report on them.
    """
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _job_roots:
        cfg = _config(spark, _raw_images(spark, sf_dir))
        first = CurationConfig(**{**vars(cfg), "num_batches": FIRST_RUN_BATCHES})
        run_stages(spark, first, filter_model(), label_model())
        run_stages(spark, cfg, filter_model(), label_model())
        _job_roots[key] = cfg
    return _job_roots[key]


def _filter_columns(rows, *extra):
    return rows.select(
        *extra,
        "id",
        "file_name",
        "file_path",
        F.md5("image_bytes").alias("image_md5"),
        "image_format",
        "width",
        "height",
        "filter_result",
        "error",
    )


def _label_columns(rows, *extra):
    return rows.select(
        *extra,
        "id",
        "file_path",
        F.md5("image_bytes").alias("image_md5"),
        "image_format",
        "filter_result",
        "label_json",
        "category",
        "subcategory",
        "description",
        "landmark",
        "city",
        "mood",
        "is_professional",
        "has_text_overlay",
        "error",
    )


@query("job_filter")
def job_filter(spark, sf_dir):
    cfg = _config(spark, _raw_images(spark, sf_dir))
    run_filter(spark, cfg, filter_model())
    rows = spark.read.parquet(cfg.output_dir("filter"))
    return _filter_columns(rows, F.col("shard").cast("bigint").alias("shard"))


@query("job_label")
def job_label(spark, sf_dir):
    cfg = _config(spark, _raw_images(spark, sf_dir))
    run_stages(spark, cfg, filter_model(), label_model())
    rows = spark.read.parquet(cfg.output_dir("label"))
    return _label_columns(rows, F.col("shard").cast("bigint").alias("shard"))


@query("job_all_stages")
def job_all_stages(spark, sf_dir):
    return _label_columns(spark.read.parquet(_two_runs(spark, sf_dir).output_dir("label")))


@query("job_incremental")
def job_incremental(spark, sf_dir):
    cfg = _config(spark, _raw_images(spark, sf_dir))
    run_incremental(spark, cfg, filter_model(), max_files=_partitions(spark) // 2 + 1)
    return _filter_columns(spark.read.parquet(cfg.output_dir("filter")))


@query("run_stats_filter")
def run_stats_filter(spark, sf_dir):
    return run_stats(attempts(spark, _two_runs(spark, sf_dir), "filter"), "filter")


@query("run_stats_label")
def run_stats_label(spark, sf_dir):
    return run_stats(attempts(spark, _two_runs(spark, sf_dir), "label"), "label")


@query("ledger_totals")
def run_totals(spark, sf_dir):
    return ledger_totals(read_ledger(spark, _two_runs(spark, sf_dir)))


@query("progress_by_batch")
def progress_by_batch(spark, sf_dir):
    return progress(attempts(spark, _two_runs(spark, sf_dir), "filter"), "filter")


@query("label_report")
def label_quality(spark, sf_dir):
    rows = label_report(spark.read.parquet(_two_runs(spark, sf_dir).output_dir("label")))
    return rows.withColumn("error_rate", F.round("error_rate", 6))


@query("quarantine")
def quarantined(spark, sf_dir):
    rows = spark.read.parquet(_two_runs(spark, sf_dir).quarantine_dir)
    return rows.select("id", "stage", "error")
