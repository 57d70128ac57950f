"""Scans of raw records and reads of stored tables."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

POSITION_COLS = ("src_file", "src_row")


def _parquet(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    reader = spark.read.schema(schema) if schema is not None else spark.read
    try:
        return reader.parquet(path)
    except AnalysisException as exc:
        if "PATH_NOT_FOUND" in str(exc):
            raise FileNotFoundError(f"no such table: {path}") from exc
        raise


def file_path() -> Column:
    """The path of the file that a row comes from, as its name is, not URL-encoded."""
    encoded = F.col("_metadata.file_path")
    decoded = F.url_decode(F.replace(encoded, F.lit("+"), F.lit("%2B")))
    return F.when(encoded.contains("%"), decoded).otherwise(encoded)


def with_source(df: DataFrame) -> DataFrame:
    """Add the file and the row within it, which together give the scan order."""
    return df.select(
        "*",
        file_path().alias("src_file"),
        F.col("_metadata.row_index").alias("src_row"),
    )


def check_columns(df: DataFrame, *names: str) -> None:
    """Fail before any work if a configured column is absent."""
    for name in names:
        if name not in df.columns:
            available = [c for c in df.columns if c not in POSITION_COLS]
            raise ValueError(f"column {name!r} not found, available: {available}")


def scan_raw(
    spark: SparkSession,
    path: str,
    id_col: str = "id",
    bytes_col: str = "data",
    schema: T.StructType | None = None,
) -> DataFrame:
    """All rows of the Parquet files directly in ``path``, or of one file.

    Columns are the union over the files.  Passing ``schema`` saves the look at
    every footer that this takes.
    """
    source = path if path.endswith(".parquet") else f"{path.rstrip('/')}/*.parquet"
    if schema is None:
        try:
            raw = spark.read.option("mergeSchema", True).parquet(source)
        except AnalysisException as exc:
            if "PATH_NOT_FOUND" in str(exc):
                raise FileNotFoundError(f"no Parquet files: {source}") from exc
            raise
    else:
        raw = _parquet(spark, source, schema)
    check_columns(raw, id_col, bytes_col)
    return with_source(raw)


def extract_bytes(col: Column, dtype: T.DataType) -> Column:
    """The payload held by a binary, struct or byte-array column; NULL for other types."""
    if isinstance(dtype, T.BinaryType):
        return col
    if isinstance(dtype, T.StructType):
        parts = [
            extract_bytes(col.getField(name), dtype[name].dataType)
            for name in ("bytes", "data")
            if name in dtype.names and not isinstance(dtype[name].dataType, T.StructType)
        ]
        return F.coalesce(*parts) if parts else F.lit(None).cast("binary")
    if isinstance(dtype, T.ArrayType) and isinstance(dtype.elementType, T.ByteType):
        digits = F.transform(col, lambda b: F.lpad(F.right(F.hex(b), F.lit(2)), 2, "0"))
        return F.when(~F.exists(col, lambda b: b.isNull()), F.unhex(F.array_join(digits, "")))
    return F.lit(None).cast("binary")


_OPERATORS = {
    "=": lambda c, v: c == v,
    "==": lambda c, v: c == v,
    "!=": lambda c, v: c != v,
    "<": lambda c, v: c < v,
    "<=": lambda c, v: c <= v,
    ">": lambda c, v: c > v,
    ">=": lambda c, v: c >= v,
    "in": lambda c, v: c.isin(list(v)),
    "not in": lambda c, v: ~c.isin(list(v)),
}


def predicate(filters: Sequence) -> Column:
    """``[(col, op, value), …]`` is a conjunction, a list of such lists a disjunction."""
    groups = filters if isinstance(filters[0], list) else [filters]

    def comparison(term: tuple) -> Column:
        name, op, value = term
        if op not in _OPERATORS:
            raise ValueError(f"unknown operator {op!r}")
        return _OPERATORS[op](F.col(name), value)

    return reduce(
        lambda a, b: a | b,
        [reduce(lambda a, b: a & b, [comparison(term) for term in group]) for group in groups],
    )


def read_table(
    spark: SparkSession,
    path: str,
    columns: Sequence[str] | None = None,
    filters: Sequence | None = None,
) -> DataFrame:
    """A stored table; both the projection and the predicate reach the Parquet scan."""
    df = _parquet(spark, path)
    if filters:
        df = df.where(predicate(filters))
    return df.select(*columns) if columns else df


def read_stage(
    spark: SparkSession,
    path: str,
    columns: Sequence[str] | None = None,
    verdict: str | None = "YES",
) -> DataFrame:
    """The output of the filter stage; a falsy ``verdict`` keeps all rows."""
    return read_table(spark, path, columns, [("filter_result", "=", verdict)] if verdict else None)
