"""Near-duplicate lines: MinHash over character shingles, one line kept of each component.

Lines that are equal once case and white space are folded are met by 128-bit
hashes first, so that each is sketched once and only one of them is carried on.
The others take the way of ``near``: equal sets are folded, bands of minhashes
propose pairs, a sequential test prunes them, exact Jaccard similarity of the
full shingle sets confirms, and a distributed union-find joins them.

Minhashes are made in numpy inside Arrow batches. With SQL functions alone a
minhash is a higher-order function over an array of one hash per character,
which is interpreted; the README has the figures.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleanery.session import Scratch, prepare, stored

from .near import NearRule, near_duplicates

# Bands of 4 find a pair at a similarity of 0.75 with a chance of 0.998, at 0.85 with one of 0.99999.
LINES = NearRule(chars=8, bands=16, rows=4, batch=16)


def near_duplicate_lines(
    df: DataFrame, rule: NearRule = LINES, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per line of ``df``: doc_id, line (from 0), n_shingles, component_doc, component_line, kept.

    Lines end at line feeds; a text has one line more than line feeds, so null
    and empty texts have one empty line. A-Z count as lower case, white space is
    folded and trimmed; a line shorter than a shingle is one shingle. Lines
    without characters are linked with nothing and kept. Of each component the
    first line by id (nulls last) and line is kept; rows that repeat an id are
    told apart by place. Other columns are ignored.
    """
    spark = prepare(df.sparkSession)
    with Scratch(spark) as tmp:
        return stored(_near_duplicate_lines(tmp, df, rule, id_col, text_col))


def _near_duplicate_lines(tmp: Scratch, df: DataFrame, rule: NearRule, id_col: str, text_col: str) -> DataFrame:
    lines = df.select(
        F.col(id_col).alias("doc_id"),
        F.posexplode(F.split(F.coalesce(F.col(text_col), F.lit("")), "\n")).alias("line", "text"),
    )
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ\t\n\x0b\f\r", "abcdefghijklmnopqrstuvwxyz     "
    folded = F.trim(F.regexp_replace(F.translate("text", upper, lower), "  +", " "))
    lines = lines.withColumn("text", folded)
    hashes = F.xxhash64("text").alias("h1"), F.xxhash64(F.lit(1), "text").alias("h2")
    rows = tmp.store(lines.select(F.monotonically_increasing_id().alias("row"), "doc_id", "line", *hashes))
    texts = tmp.store(lines.select(*hashes, "text").dropDuplicates(["h1", "h2"]), compression="zstd")

    found = near_duplicates(texts.select(F.struct("h1", "h2").alias("key"), "text"), rule, id_col="key", unique_ids=True)
    classes = found.select(
        "doc_id.h1", "doc_id.h2", "n_shingles", F.when(F.col("n_shingles") > 0, F.col("component_id")).alias("component")
    )
    rows = tmp.store(rows.join(classes, ["h1", "h2"]).drop("h1", "h2"))
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "line", "row")
    best = rows.where("component IS NOT NULL").groupBy("component").agg(F.min(order).alias("best"))
    # Lines without shingles stand alone.
    first = F.coalesce("best", order)
    return rows.join(tmp.store(best), "component", "left").select(
        "doc_id",
        "line",
        "n_shingles",
        first["doc_id"].alias("component_doc"),
        first["line"].alias("component_line"),
        (first["row"] == F.col("row")).alias("kept"),
    )
