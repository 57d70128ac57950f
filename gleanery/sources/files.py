"""File manifests, and loads selected by file name pattern."""

from __future__ import annotations

import fnmatch
import re
from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def file_manifest(
    spark: SparkSession, path: str, pattern: str = "*", recursive: bool = False
) -> DataFrame:
    """One row per file: path, path below ``path``, length and modification time.

    The content column is pruned, so no file is opened.
    """
    reader = spark.read.format("binaryFile").option("pathGlobFilter", pattern)
    try:
        found = reader.option("recursiveFileLookup", "true").load(path)
    except AnalysisException as exc:
        if "PATH_NOT_FOUND" not in str(exc):
            raise
        raise FileNotFoundError(f"no such folder: {path}") from exc
    files = found.select("path", "length", F.col("modificationTime").alias("modified_at"))
    root = re.escape(re.sub(r"^[a-z0-9]+:/*", "/", path).rstrip("/"))
    listed = files.select(
        "path",
        F.regexp_replace("path", rf"^.*?{root}/", "").alias("rel_path"),
        "length",
        "modified_at",
    )
    if not recursive:
        listed = listed.where(~F.col("rel_path").contains("/"))
    return listed.orderBy("path")


def glob_match(path: Column, patterns: Sequence[str]) -> Column:
    """True where any shell pattern matches the whole path."""
    expressions = [re.sub(r"^\(\?s:(.*)\)\\[zZ]$", r"\1", fnmatch.translate(p)) for p in patterns]
    joined = "|".join(f"(?:{e})" for e in expressions)
    return path.rlike(rf"(?s)\A(?:{joined})\z")


def select_files(
    manifest: DataFrame,
    repo_path: str,
    allow: Sequence[str] | None = None,
    ignore: Sequence[str] | None = None,
    file_filter: Callable[[Column], Column] | None = None,
) -> DataFrame:
    """Manifest rows whose ``rel_path`` is allowed and not ignored.

    ``allow`` replaces the default, everything below ``repo_path``; the latter
    is taken off the front of ``rel_path``.  ``file_filter`` maps the full
    ``rel_path`` to a further condition.
    """
    rel = F.col("rel_path")
    prefix = repo_path.strip("/")
    chosen = manifest.where(glob_match(rel, list(allow) if allow else [f"{prefix}/*"]))
    if ignore:
        chosen = chosen.where(~glob_match(rel, ignore))
    if file_filter is not None:
        chosen = chosen.where(file_filter(rel))
    return chosen.withColumn("rel_path", F.regexp_replace(rel, f"^{re.escape(prefix)}/", ""))


def load_selected(spark: SparkSession, selected: DataFrame, base_path: str) -> DataFrame:
    """The rows of the selected Parquet files below ``base_path``.

    Files that were not chosen are neither listed nor opened, however many are.
    Paths come to the driver, which lists the files of any scan.
    """
    paths = [row["path"] for row in selected.select("path").collect()]
    if not paths:
        raise FileNotFoundError(f"no file selected in {base_path}")
    return spark.read.option("basePath", base_path).option("mergeSchema", True).parquet(*paths)
