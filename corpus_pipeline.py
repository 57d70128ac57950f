"""From raw documents to packed sequences: quality, exact and near duplicates, repeated passages, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes
it as Parquet and gives it to the next. All but the last return the columns of
``documents``. A document keeps its row: ids that repeat stand for documents of
their own, told apart by place.

- quality: documents that the line model scores under 0.3 go.
- exact: of equal texts (white space folded), the row with the smallest id stays.
- near: of each component of near duplicates, the row with the smallest id stays.
- passages: words under 20-word windows that occur earlier go; documents
  without such windows are unchanged, and n_chars is counted anew where it was.
- packing: one row per piece of at most 4096 tokens.

Null and empty texts pass through every stage (as one document, since they are
equal), an empty table gives an empty result, and other columns of ``docs`` are
left behind.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanery.llm.exact import exact_duplicates
from gleanery.llm.near import near_duplicates
from gleanery.llm.packing import pack_documents
from gleanery.llm.quality import fit_quality, score_quality
from gleanery.llm.substring import remove_repeats
from gleanery.session import hint_if_small, stored

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    docs = docs.select(*COLUMNS)
    model = fit_quality(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return score_quality(docs, model).where("predicted = 1").select(*COLUMNS)


def _numbered(docs: DataFrame) -> DataFrame:
    """``docs`` with a place of its own for each row, which every reading of the same files gives again."""
    try:
        at = F.struct(F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"))
        return docs.select(at.alias("place"), *COLUMNS)
    except AnalysisException:  # not straight from files: written down, so that it stays
        return stored(docs.select(F.monotonically_increasing_id().alias("place"), *COLUMNS))


def _key() -> Column:
    """Ids in order, nulls last, then places."""
    return F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id"), F.col("place"))


def _first_of_each(docs: DataFrame, find: Callable[..., DataFrame]) -> DataFrame:
    """The rows that ``find`` keeps, told by (id, place), so that ids may repeat."""
    numbered = _numbered(docs)
    dropped = find(numbered.select(_key().alias("key"), "text"), id_col="key").where(~F.col("kept"))
    dropped = stored(dropped.select(F.col("doc_id.place").alias("place")))
    return numbered.join(hint_if_small(dropped), "place", "left_anti").select(*COLUMNS)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _first_of_each(docs, exact_duplicates)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _first_of_each(docs, near_duplicates)


def passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    numbered = _numbered(docs)
    cut = remove_repeats(numbered.select(_key().alias("key"), "text"), id_col="key", with_text=True)
    cut = stored(cut.where("kept_text IS NOT NULL").select(F.col("doc_id.place").alias("place"), "kept_text"))
    # Texts that stay as they are do not move.
    same = numbered.join(hint_if_small(cut.select("place")), "place", "left_anti").select(*COLUMNS)
    changed = cut.join(numbered.drop("text", "n_chars"), "place").select(
        "doc_id", F.col("kept_text").alias("text"), "lang", "source", F.char_length("kept_text").cast("long").alias("n_chars")
    )
    return same.union(changed)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack_documents(docs, "file://" + public_tokenizers.path("word_bpe_49k.json"))


STAGES = [("quality", quality), ("exact", exact), ("near", near), ("passages", passages), ("packing", packing)]

# SQL can train no model and run no tokenizer; tests hold every stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir))
    return docs
