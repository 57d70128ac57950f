"""Uniform random shards of exact sizes, by a hypergeometric communication matrix.

How many rows each input part sends to each shard is drawn first, exactly as a
uniform shuffle of all rows would distribute them: one multivariate
hypergeometric draw per part from the places that are left. Then rows are
permuted inside their part, dealt out by the counts, and permuted again inside
their shard. Only the counts, one number per part and shard, are made on the
driver; rows travel as ids, sizes and checksums.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gleanery.session import Scratch, stored

# A shard is permuted in so many slices of the range of its random keys.
SLICES = 1024


def communication_matrix(rows: list[int], shards: int, seed: int) -> np.ndarray:
    """Rows that each part sends to each shard; shard sizes differ by one at most.

    Shards are drawn one after the other from what the part still has to send.
    """
    total = sum(rows)
    left = np.full(shards, total // shards, dtype=np.int64)
    left[: total % shards] += 1
    rng = np.random.default_rng(seed)
    out = np.zeros((len(rows), shards), dtype=np.int64)
    for i, n in enumerate(rows):
        out[i] = _draw(rng, left, n)
        left -= out[i]
    return out


def _draw(rng: np.random.Generator, left: np.ndarray, n: int) -> np.ndarray:
    out = np.zeros_like(left)
    rest = int(left.sum())
    for j, good in enumerate(map(int, left)):
        rest -= good
        out[j] = _hypergeometric(rng, good, rest, n)
        n -= int(out[j])
    return out


def _hypergeometric(rng: np.random.Generator, good: int, bad: int, n: int) -> int:
    """How many of ``n`` places drawn are good ones; numpy draws for up to 10^9 places."""
    if good + bad < 10**9:
        return int(rng.hypergeometric(good, bad, n))
    low, high = max(0, n - bad), min(n, good)
    mode = min(max((n + 1) * (good + 1) // (good + bad + 2), low), high)
    log = math.lgamma
    p = math.exp(
        sum(log(a + 1) - log(k + 1) - log(a - k + 1) for a, k in ((good, mode), (bad, n - mode)))
        - (log(good + bad + 1) - log(n + 1) - log(good + bad - n + 1))
    )
    # Inversion, from the mode outwards.
    u = rng.random() - p
    down, up, p_down, p_up = mode, mode, p, p
    while u > 0 and (down > low or up < high):
        if up < high:
            p_up *= (good - up) * (n - up) / ((up + 1) * (bad - n + up + 1))
            up += 1
            u -= p_up
            if u <= 0:
                return up
        if down > low:
            p_down *= down * (bad - n + down) / ((good - down + 1) * (n - down + 1))
            down -= 1
            u -= p_down
            if u <= 0:
                return down
    return mode


def shard_rows(
    df: DataFrame,
    shards: int = 24,
    seed: int = 11,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per row of ``df``: doc_id, size, text_crc32, law, shard, slot, grown_shard.

    The law is ``rows``: shards hold numbers of rows that differ by one at most,
    and every assignment of rows to places is equally likely; equal texts are
    dealt out like any other rows. size is the number of UTF-8 bytes plus 8, 8
    for null; text_crc32 that of the bytes (null: 0). slot counts from 0 in each
    shard without gaps. grown_shard is null, as this law moves rows at will when
    the number of shards changes. Null and repeated ids are rows like others; an
    empty table gives no rows. Other columns are ignored.
    """
    with Scratch(df.sparkSession) as tmp:
        return stored(_shard_rows(tmp, df, shards, seed, id_col, text_col))


def _shard_rows(
    tmp: Scratch,
    df: DataFrame,
    shards: int,
    seed: int,
    id_col: str,
    text_col: str,
) -> DataFrame:
    spark = df.sparkSession
    text = F.coalesce(F.col(text_col), F.lit(""))
    place = F.monotonically_increasing_id()
    placed = tmp.store(
        df.select(
            F.col(id_col).alias("doc_id"),
            (F.octet_length(text) + 8).cast("long").alias("size"),
            F.crc32(text.cast("binary")).alias("text_crc32"),
            place.alias("place"),
        )
    ).withColumn("part", F.shiftright("place", 33))
    counts = sorted((r["part"], r["n"]) for r in placed.groupBy("part").agg(F.count("*").alias("n")).collect())
    matrix = communication_matrix([n for _, n in counts], shards, seed)
    ends = [(part, [int(x) for x in np.cumsum(sent)]) for (part, _), sent in zip(counts, matrix, strict=True)]
    ends = spark.createDataFrame(ends, "part long, ends array<long>")

    # Permute inside the part and deal out.
    local = F.row_number().over(Window.partitionBy("part").orderBy(F.xxhash64("place", F.lit(seed)), "place")) - 1
    dealt = placed.withColumn("turn", local).join(ends, "part")
    dealt = dealt.withColumn("shard", F.size(F.filter("ends", lambda end: end <= F.col("turn"))))

    # Permute inside the shard.
    key = F.xxhash64("place", F.lit(seed + 1), "shard")
    dealt = dealt.select("doc_id", "size", "text_crc32", "shard", "place", key.alias("key"))
    dealt = tmp.store(dealt.withColumn("slice", F.shiftrightunsigned("key", 64 - SLICES.bit_length() + 1)))
    before = dealt.groupBy("shard", "slice").agg(F.count("*").alias("n"))
    ahead = F.sum("n").over(Window.partitionBy("shard").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1))
    before = before.select("shard", "slice", F.coalesce(ahead, F.lit(0)).alias("ahead"))
    inner = F.row_number().over(Window.partitionBy("shard", "slice").orderBy("key", "place")) - 1
    return dealt.withColumn("inner", inner).join(before, ["shard", "slice"]).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        (F.col("ahead") + F.col("inner")).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
