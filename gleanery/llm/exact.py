"""Exact duplicates by deterministic block naming.

Normalised texts are cut into blocks of a fixed number of bytes. Distinct blocks
are sorted into integer names; then adjacent pairs of names are named in the
same way, level by level, until every document has a single name. Two documents
get the same (level, name) if and only if their texts are equal.

The contents of blocks are shuffled once, already distinct per task, to show
that a 128-bit hash tells all of them apart (otherwise another seed is taken).
After that only hashes and names move. Names are made in fixed buckets of the
key space, each sorted by itself, so that no task sorts all of them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gleanery.session import Scratch, stored

WHITE_SPACE = r"[\x20\x09-\x0D]+"

# Parts of the key space that are sorted separately; a name is rank * NAME_BUCKETS + bucket.
NAME_BUCKETS = 4096


def normalised(text: Column) -> Column:
    """Runs of white space as one space; null as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), WHITE_SPACE, " ")


def _blocks(body: Column, block_bytes: int) -> Column:
    """The bytes of a text in blocks; an empty text has one empty block."""
    last = F.greatest(F.lit(0), F.floor((F.octet_length(body) - 1) / block_bytes)).cast("int")
    raw = body.cast("binary")
    return F.transform(F.sequence(F.lit(0), last), lambda i: F.substring(raw, i * block_bytes + 1, F.lit(block_bytes)))


def _hash(block: Column, seed: int, bits: int) -> tuple[Column, Column]:
    high = F.xxhash64(block, F.lit(seed))
    low = F.xxhash64(F.lit(seed), block)
    return (F.shiftrightunsigned(high, 64 - bits), F.lit(0).cast("long")) if bits < 64 else (high, low)


def _names(keys: DataFrame) -> DataFrame:
    """(x, y, name) for the distinct pairs of ``keys``."""
    bucket = F.pmod(F.xxhash64("x", "y"), F.lit(NAME_BUCKETS))
    distinct = keys.select("x", "y").distinct().withColumn("bucket", bucket)
    rank = F.row_number().over(Window.partitionBy("bucket").orderBy("x", "y")).cast("long")
    return distinct.select("x", "y", (rank * NAME_BUCKETS + F.col("bucket")).alias("name"))


def _seed(body: DataFrame, block_bytes: int, bits: int) -> tuple[int, int]:
    """A seed (and width) under which no two different blocks have the same hash."""
    seed = 0
    while True:
        block = body.select(F.explode(_blocks(F.col("body"), block_bytes)).alias("block"))
        x, y = _hash(F.col("block"), seed, bits)
        distinct = block.select(x.alias("x"), y.alias("y"), "block").groupBy("x", "y", "block").agg(F.lit(1).alias("one"))
        twice = distinct.groupBy("x", "y").agg(F.count("*").alias("n")).where("n > 1")
        if twice.isEmpty():
            return seed, bits
        seed, bits = seed + 1, min(64, bits * 2)


def exact_duplicates(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    block_bytes: int = 4096,
    hash_bits: int = 64,
) -> DataFrame:
    """One row per row of ``df``: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal if they are so after every run of white space is replaced by
    one space. Null counts as empty; empty texts are equal to each other, but a
    text of white space only is one space. keep_id is the smallest id of the
    group; ids may repeat or be null (null only if all ids of the group are).
    kept marks one row of each group, the first by id (nulls last), then by
    place. Other columns are ignored, whatever their names. ``hash_bits`` below
    64 narrows the first hash, for tests of the collision check.
    """
    with Scratch(df.sparkSession) as tmp:
        return stored(_exact_duplicates(tmp, df, id_col, text_col, block_bytes, hash_bits))


def _exact_duplicates(
    tmp: Scratch,
    df: DataFrame,
    id_col: str,
    text_col: str,
    block_bytes: int,
    hash_bits: int,
) -> DataFrame:
    body = df.select(F.col(id_col).alias("doc_id"), normalised(F.col(text_col)).alias("body"))
    seed, bits = _seed(body, block_bytes, hash_bits)

    def key(block: Column) -> Column:
        x, y = _hash(block, seed, bits)
        return F.struct(x.alias("x"), y.alias("y"))

    docs = tmp.store(
        body.select(
            F.monotonically_increasing_id().alias("row"),
            "doc_id",
            F.sha2("body", 256).alias("sha"),
            F.transform(_blocks(F.col("body"), block_bytes), key).alias("keys"),
        )
    )
    level = docs.select("row", F.size("keys").alias("n"), F.posexplode("keys").alias("pos", "key"))
    level = level.select("row", "n", "pos", "key.x", "key.y")
    left, depth, done = docs.agg(F.max(F.size("keys"))).first()[0] or 0, 0, None
    while left > 0:
        named = tmp.store(level.join(_names(level), ["x", "y"]).select("row", "n", "pos", "name"))
        ended = named.where("n = 1").select("row", F.lit(depth).alias("depth"), "name")
        done = ended if done is None else done.union(ended)
        even = F.col("pos") % 2 == 0
        level = (
            named.where("n > 1")
            .groupBy("row", F.floor(F.col("pos") / 2).cast("int").alias("pos"))
            .agg(
                F.max("n").alias("n"),
                F.max(F.when(even, F.col("name"))).alias("x"),
                F.coalesce(F.max(F.when(~even, F.col("name"))), F.lit(-1).cast("long")).alias("y"),
            )
            .withColumn("n", F.floor((F.col("n") + 1) / 2).cast("int"))
        )
        if left > 1:
            level = tmp.store(level)
        left, depth = (left + 1) // 2 if left > 1 else 0, depth + 1
    rows = docs.select("row", "doc_id", "sha")
    if done is None:
        rows = rows.select("*", F.lit(0).alias("depth"), F.lit(0).cast("long").alias("name"))
    else:
        rows = tmp.store(rows.join(done, "row"))
    order = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id"), F.col("row"))
    groups = tmp.store(rows.groupBy("depth", "name").agg(F.min(order).alias("best"), F.count("*").alias("group_size")))
    return rows.join(groups, ["depth", "name"]).select(
        "doc_id",
        F.col("best.doc_id").alias("keep_id"),
        "group_size",
        (F.col("best.row") == F.col("row")).alias("kept"),
        F.col("sha").alias("text_sha256"),
    )
