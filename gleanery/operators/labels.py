"""From model answers to label columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanery.functions import json_labels as J
from gleanery.functions.text import let
from gleanery.session import prepare


def flatten_label(df: DataFrame, document: str = "document") -> DataFrame:
    """Add the typed label columns of a variant column."""
    return df.withColumn("_label", let(F.col(document), J.label_struct)).select(*df.columns, "_label.*")


def parse_labels(df: DataFrame, answer: str = "answer") -> DataFrame:
    """Add ``label_json``, the label columns, ``error`` and ``rejected``.

    A row with ``error`` is written without labels.  A row with ``rejected``
    holds valid JSON that cannot become a label row, and goes to quarantine.
    """
    prepare(df.sparkSession)
    raw = F.col(answer)

    def verdict(document: Column) -> Column:
        def fields(rejected: Column) -> Column:
            usable = F.when(rejected.isNull(), document)
            return F.struct(
                J.label_struct(usable).alias("label"),
                J.parse_error(raw, document).alias("error"),
                F.when(document.isNotNull(), raw).alias("label_json"),
                rejected.alias("rejected"),
            )

        return let(J.rejection(document), fields)

    parsed = df.withColumn("_parsed", let(J.answer_document(raw), verdict))
    return parsed.select(
        *df.columns, "_parsed.label_json", "_parsed.label.*", "_parsed.error", "_parsed.rejected"
    )


def vocab_flags(df: DataFrame) -> DataFrame:
    """Add ``category_known`` and ``mood_known``; unknown values stay as they are."""
    return df.withColumns(
        {
            "category_known": J.category_known(F.col("category")),
            "mood_known": J.mood_known(F.col("mood")),
        }
    )
