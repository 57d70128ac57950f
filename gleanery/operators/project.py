"""Projections between the raw, normalised and output schemas."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gleanery.functions.image import decoded_size, header_probe, jpeg_size
from gleanery.functions.text import let
from gleanery.schemas import FILTER_OUTPUT, LABEL_OUTPUT
from gleanery.session import prepare
from gleanery.sources.scan import POSITION_COLS, check_columns, extract_bytes


def row_uuid(*seed: Column) -> Column:
    """A UUID-shaped id that a retried task computes again."""
    return F.regexp_replace(
        F.md5(F.concat_ws("|", *seed)),
        "^(.{8})(.{4}).(.{3}).(.{3})(.{12})$",
        "$1-$2-4$3-a$4-$5",
    )


def normalize(
    df: DataFrame,
    id_col: str = "id",
    bytes_col: str = "data",
    ingested_at: Column | None = None,
) -> DataFrame:
    """Raw rows with fixed column names.

    ``source_id`` is the id as found, ``id`` the same or a generated one where
    it is empty.  Of the other columns only ``file_path`` survives.
    """
    check_columns(df, id_col, bytes_col)
    source_id = F.col(id_col).cast("string")
    position = [c for c in POSITION_COLS if c in df.columns]
    generated = row_uuid(*[F.col(c) for c in position]) if len(position) == 2 else F.uuid()
    has_path = "file_path" in df.columns and "file_path" not in (id_col, bytes_col)
    return df.select(
        F.when(source_id == "", generated).otherwise(source_id).alias("id"),
        source_id.alias("source_id"),
        source_id.alias("file_name"),
        (F.col("file_path").cast("string") if has_path else F.lit("")).alias("file_path"),
        extract_bytes(F.col(bytes_col), df.schema[bytes_col].dataType).alias("image_bytes"),
        (F.current_timestamp() if ingested_at is None else ingested_at).alias("ingested_at"),
        *position,
    )


def conform(df: DataFrame, schema: T.StructType, *extra: str) -> DataFrame:
    """Exactly the columns of ``schema`` in its order, then any ``extra`` ones."""
    return df.select(
        *[
            (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ],
        *extra,
    )


def image_metadata(
    df: DataFrame,
    bytes_col: str = "image_bytes",
    mode: str = "sniff",
    decoder: Callable[[bytes], tuple[str, int, int] | None] | None = None,
) -> DataFrame:
    """Add ``width``, ``height``, ``image_format`` and ``decodable`` from the headers.

    ``mode='reference'`` names every decodable payload JPEG.  With ``decoder``,
    which gives ``(format, width, height)`` or fails, a full decode of every
    payload decides instead of its header.
    """
    if mode not in ("sniff", "reference"):
        raise ValueError(f"unknown mode {mode!r}")
    prepare(df.sparkSession)
    data = F.col(bytes_col)
    plain = df.drop("width", "height", "image_format", "decodable")
    if decoder is None:
        probed = plain.withColumn("_head", header_probe(bytes_col)).withColumn(
            "_jpeg", jpeg_size(data, F.col("_head.format"))
        )
    else:
        probed = plain.withColumn("_head", decoded_size(data, decoder)).withColumn("_jpeg", F.col("_head"))

    def described(found: Column) -> Column:
        width = F.coalesce(found["head"]["width"], found["jpeg"]["width"])
        height = F.coalesce(found["head"]["height"], found["jpeg"]["height"])
        decodable = width.isNotNull() & height.isNotNull()
        form = F.lit("JPEG") if mode == "reference" else found["head"]["format"]
        return F.struct(
            F.nullif(width, F.lit(0)).alias("width"),
            F.nullif(height, F.lit(0)).alias("height"),
            F.when(decodable, form).alias("image_format"),
            decodable.alias("decodable"),
        )

    found = F.struct(F.col("_head").alias("head"), F.col("_jpeg").alias("jpeg"))
    return probed.withColumn("_image", let(found, described)).select(*plain.columns, "_image.*")


def payload_error(id_col: str = "id", bytes_col: str = "image_bytes") -> Column:
    """Why a row of ``image_metadata`` cannot be judged; NULL where it can."""
    name = F.col(id_col)
    data = F.col(bytes_col)
    return (
        F.when(name.isNull(), F.lit("row has no id"))
        .when(data.isNull() | (F.octet_length(data) == 0), F.concat(F.lit("no image data for id="), name))
        .when(~F.col("decodable"), F.concat(F.lit("undecodable image data for id="), name))
    )


def to_filter_output(df: DataFrame, *extra: str, processed_at: Column | None = None) -> DataFrame:
    """Rows of the filter stage; only a YES keeps its payload."""
    verdict = F.upper(F.col("filter_result"))
    shaped = df.withColumns(
        {
            "filter_result": verdict,
            "image_bytes": F.when(verdict == "YES", F.col("image_bytes")),
            "processed_at": F.current_timestamp() if processed_at is None else processed_at,
            "error": F.col("error") if "error" in df.columns else F.lit(None).cast("string"),
        }
    )
    return conform(shaped, FILTER_OUTPUT, *extra)


def split_verdict(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The kept and the rejected rows of one filter output table."""
    verdict = F.upper(F.col("filter_result"))
    return df.where(verdict == "YES"), df.where(verdict == "NO")


def to_label_output(df: DataFrame, *extra: str, processed_at: Column | None = None) -> DataFrame:
    """Rows of the label stage: the record, its labels and the run columns."""
    now = F.current_timestamp() if processed_at is None else processed_at
    return conform(df.withColumn("processed_at", now), LABEL_OUTPUT, *extra)


_PART = "struct<type:string,text:string,image:binary>"


def request_messages(
    system_prompt: str,
    user_prompt: str,
    image_cols: Sequence[str] = (),
    text_cols: Sequence[str] = (),
) -> Column:
    """The request for one model call: images, then extra texts, then the prompt."""

    def part(kind: str, text: Column | None = None, image: Column | None = None) -> Column:
        return F.struct(
            F.lit(kind).alias("type"),
            (F.lit(None) if text is None else text).cast("string").alias("text"),
            (F.lit(None) if image is None else image).cast("binary").alias("image"),
        ).cast(_PART)

    def message(role: str, parts: Column) -> Column:
        return F.struct(F.lit(role).alias("role"), parts.alias("content"))

    optional = [F.when(F.col(c).isNotNull(), part("image", image=F.col(c))) for c in image_cols]
    optional += [F.when(F.col(c).isNotNull(), part("text", text=F.col(c))) for c in text_cols]
    parts = F.array(*optional, part("text", F.lit(user_prompt)))
    return F.array(
        message("system", F.array(part("text", F.lit(system_prompt)))),
        message("user", F.filter(parts, lambda p: p.isNotNull()) if optional else parts),
    )


def build_request(
    df: DataFrame,
    system_prompt: str,
    user_prompt: str,
    image_cols: Sequence[str] = (),
    text_cols: Sequence[str] = (),
) -> DataFrame:
    """Add the ``messages`` column that ``infer`` sends to a model."""
    return df.withColumn("messages", request_messages(system_prompt, user_prompt, image_cols, text_cols))
