"""Near duplicates of documents: MinHash bands propose, a sequential Bayesian test prunes, full sets confirm.

Documents are linked when the Jaccard similarity of their sets of word shingles
reaches a threshold; classes are the connected components of these links.

1. *Sketch.* One pass gives each document a 128-bit key of its set, minhashes,
   of which bands are hashed to bucket numbers and one byte each is kept.
2. *Classes of equal sets* are folded into one node first, by a partial aggregate.
3. *Stars.* Every node is paired with the smallest and the largest node of each
   of its buckets, which is linear in the bucket's size.
4. *Sequential test.* Pairs are compared in batches of minhash bytes; a pair is
   dropped once the posterior probability that it reaches the threshold falls
   below the chosen miss probability.
5. *Confirmation* of survivors on full sets, made again from the texts: one pair
   per node first, then those that are still in different components.
6. *The rest.* In buckets whose nodes are in several components, nodes outside
   the bucket's largest component are paired with all nodes of other
   components. Pairs inside one component need no test, since they can't change it.
   A node's shingles that no other component has are in no intersection it could
   need. The others are counted and marked in a bitmap; a pair is made only if the
   counts, less the marks that the other lacks, can still reach the threshold.

No pair that shares a bucket and could join two components is left out, and no
bucket is capped: the bounds of step 6 are never below the true intersection. With 48 bands of 4, two sets at a similarity of 0.75 share no
bucket with a probability of about 1e-8.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache, partial, reduce

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gleanery.session import BROADCAST_BYTES, Scratch, hint_if_small, measured_bytes, prepare, stored

from .components import components
from .words import LOWER, gram_hashes, mix, small, text_slices, word_bounds, word_hashes


@dataclass(frozen=True)
class NearRule:
    """``numerator / denominator`` is the least similarity; ``miss`` the chance that a step of the test drops a link.

    Shingles are of ``words`` words or, if it is not 0, of ``chars`` characters
    of the text with white space folded and trimmed.
    """

    words: int = 5
    chars: int = 0
    numerator: int = 75
    denominator: int = 100
    bands: int = 48
    rows: int = 4
    batch: int = 24
    miss: float = 1e-8
    seed: int = 7

    @property
    def hashes(self) -> int:
        return self.bands * self.rows


@cache
def _multipliers(rule: NearRule) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(rule.seed)
    odd = rng.integers(0, 2**31, rule.hashes, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
    return odd, rng.integers(0, 2**32, rule.hashes, dtype=np.uint32)


@cache
def least_matches(rule: NearRule) -> list[tuple[int, int]]:
    """(minhashes compared, least matches to go on) after each batch.

    A byte of two minhashes agrees with probability J + (1 - J) / 256; the
    prior of J is uniform.
    """
    j = (np.arange(20_000) + 0.5) / 20_000
    p = j + (1 - j) / 256
    wanted = j >= rule.numerator / rule.denominator
    steps = []
    for n in range(rule.batch, rule.hashes + 1, rule.batch):
        m = np.arange(n + 1)[:, None]
        logs = m * np.log(p) + (n - m) * np.log1p(-p)
        weight = np.exp(logs - logs.max(axis=1, keepdims=True))
        posterior = weight[:, wanted].sum(axis=1) / weight.sum(axis=1)
        steps.append((n, int(np.argmax(posterior >= rule.miss))))
    return steps


def _sets(rule: NearRule, column: pa.Array) -> Iterator[np.ndarray]:
    """For each text, its distinct shingles as sorted 64-bit hashes."""
    if rule.chars:
        yield from _char_sets(rule, column)
        return
    for _, offsets, data in text_slices(column):
        data = LOWER[data]
        starts, ends, first = word_bounds(offsets, data)
        words = word_hashes(data, starts, ends)
        grams = gram_hashes(words, rule.words)
        for i in range(len(first) - 1):
            a, b = first[i], first[i + 1]
            if b - a >= rule.words:
                yield np.unique(grams[a : b - rule.words + 1])
            elif b > a:
                yield mix(gram_hashes(words[a:b], b - a) + np.uint64(b - a))
            else:
                yield np.zeros(0, dtype=np.uint64)


def _char_sets(rule: NearRule, column: pa.Array) -> Iterator[np.ndarray]:
    for _, offsets, data in text_slices(column):
        raw = LOWER[data].tobytes()
        texts = [b" ".join(raw[a:b].split()).decode() for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
        units = mix(np.frombuffer("".join(texts).encode("utf-32-le"), dtype="<u4").astype(np.uint64))
        grams, at = gram_hashes(units, rule.chars), 0
        for text in texts:
            n = len(text)
            if n >= rule.chars:
                yield np.unique(grams[at : at + n - rule.chars + 1])
            elif n:
                yield mix(gram_hashes(units[at : at + n], n) + np.uint64(n))
            else:
                yield np.zeros(0, dtype=np.uint64)
            at += n


def _key(shingles: np.ndarray) -> tuple[int, int]:
    spread = mix(shingles ^ np.uint64(0xD6E8FEB86659FD93))
    n = len(shingles) * 0x9E3779B97F4A7C15
    return tuple(
        int(np.uint64((int(x.sum(dtype=np.uint64)) + n) % 2**64).astype(np.int64)) for x in (shingles, spread * spread)
    )


# Shingles whose minhashes are taken at once, so that the product stays in the cache.
_STEP = 2048


def _minhashes(rule: NearRule, shingles: np.ndarray) -> np.ndarray:
    odd, add = _multipliers(rule)
    x = (shingles >> np.uint64(32)).astype(np.uint32)
    out = np.full(rule.hashes, 2**32 - 1, dtype=np.uint32)
    for at in range(0, len(x), _STEP):
        product = np.multiply.outer(odd, x[at : at + _STEP])
        product += add[:, None]
        np.minimum(out, product.min(axis=1), out=out)
    return out


def _buckets(rule: NearRule, minhashes: np.ndarray) -> np.ndarray:
    rows = minhashes.reshape(rule.bands, rule.rows).astype(np.uint64)
    out = np.arange(rule.bands, dtype=np.uint64)
    for i in range(rule.rows):
        out = mix(out * np.uint64(0x9E3779B97F4A7C15) + rows[:, i])
    return out.view(np.int64)


def _sketch(df: DataFrame, rule: NearRule, id_col: str, text_col: str) -> DataFrame:
    """doc_id, its row, and n_shingles, set key, bytes of minhashes and buckets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches):
            n, key1, key2, sig, buckets = [], [], [], [], []
            for shingles in _sets(rule, batch.column("text")):
                n.append(len(shingles))
                k = _key(shingles)
                key1.append(k[0])
                key2.append(k[1])
                if len(shingles):
                    minhashes = _minhashes(rule, shingles)
                    sig.append((mix(minhashes.astype(np.uint64)) & np.uint64(255)).astype(np.uint8).tobytes())
                    buckets.append(_buckets(rule, minhashes))
                else:
                    sig.append(None)
                    buckets.append(None)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("row"),
                    batch.column("doc_id"),
                    pa.array(n, pa.int64()),
                    pa.array(key1, pa.int64()),
                    pa.array(key2, pa.int64()),
                    pa.array(sig, pa.binary()),
                    pa.array(buckets, pa.list_(pa.int64())),
                ],
                names=["row", "doc_id", "n_shingles", "key1", "key2", "sig", "buckets"],
            )

    id_type = df.schema[id_col].dataType.simpleString()
    rows = df.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(
        run,
        f"row long, doc_id {id_type}, n_shingles long, key1 long, key2 long, sig binary, buckets array<long>",
    )


def _packed(df: DataFrame) -> DataFrame:
    """(node, text) as (node, body), the compressed text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=3)
        for batch in small(batches):
            body = [pack.compress(t.as_buffer()) if t.is_valid else b"" for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("node"), pa.array(body, pa.binary())], names=["node", "body"])

    return df.select("node", "text").mapInArrow(run, "node long, body binary")


def _bodies(df: DataFrame, rule: NearRule, text_col: str) -> DataFrame:
    """Set keys and compressed lower-case texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=3)
        for batch in small(batches):
            column = batch.column(0)
            keys = [_key(s) for s in _sets(rule, column)]
            body = [pack.compress(t.as_buffer()) if t.is_valid else b"" for t in column]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([k[0] for k in keys], pa.int64()),
                    pa.array([k[1] for k in keys], pa.int64()),
                    pa.array(body, pa.binary()),
                ],
                names=["key1", "key2", "body"],
            )

    return df.select(F.col(text_col).alias("text")).mapInArrow(run, "key1 long, key2 long, body binary")


def _test(pairs: DataFrame, sigs: DataFrame, rule: NearRule) -> DataFrame:
    """Pairs (a, b) that the sequential test keeps, with their matches."""
    steps = least_matches(rule)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches):
            x, y = (
                np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(-1, rule.hashes)
                for c in ("sig_a", "sig_b")
            )
            alive = np.arange(batch.num_rows)
            matches = np.zeros(batch.num_rows, dtype=np.int32)
            before = 0
            for n, least in steps:
                matches[alive] += (x[alive, before:n] == y[alive, before:n]).sum(axis=1, dtype=np.int32)
                alive = alive[matches[alive] >= least]
                before = n
            kept = pa.array(alive)
            yield pa.RecordBatch.from_arrays(
                [batch.column("a").take(kept), batch.column("b").take(kept), pa.array(matches[alive])],
                names=["a", "b", "matches"],
            )

    joined = pairs.join(sigs.select(F.col("node").alias("a"), F.col("sig").alias("sig_a")), "a").join(
        sigs.select(F.col("node").alias("b"), F.col("sig").alias("sig_b")), "b"
    )
    return joined.select("a", "b", "sig_a", "sig_b").mapInArrow(run, "a long, b long, matches int")


def _confirm(pairs: DataFrame, bodies: DataFrame, rule: NearRule) -> DataFrame:
    """Pairs whose full sets reach the threshold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor()
        for part in small(batches, 256):  # so that only so many sets are held
            texts = {}
            for c, body in (("a", "body_a"), ("b", "body_b")):
                for k, v in zip(part.column(c).to_pylist(), part.column(body).to_pylist(), strict=True):
                    texts.setdefault(k, v)
            raw = pa.array([unpack.decompress(v) if v else b"" for v in texts.values()], pa.binary())
            sets = dict(zip(texts, _sets(rule, raw.cast(pa.string())), strict=True))
            keep = []
            for a, b in zip(part.column("a").to_pylist(), part.column("b").to_pylist(), strict=True):
                both = len(np.intersect1d(sets[a], sets[b], assume_unique=True))
                either = len(sets[a]) + len(sets[b]) - both
                keep.append(rule.denominator * both >= rule.numerator * either)
            mask = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([part.column("a").filter(mask), part.column("b").filter(mask)], names=["a", "b"])

    joined = pairs.join(bodies.select(F.col("node").alias("a"), F.col("body").alias("body_a")), "a").join(
        bodies.select(F.col("node").alias("b"), F.col("body").alias("body_b")), "b"
    )
    return joined.select("a", "b", "body_a", "body_b").mapInArrow(run, "a long, b long")


# Bitmaps of shared shingles are so many longs.
_MARKS = 16
# Shingles are shuffled in so many parts, one after the other (a power of two).
_PARTS = 2


def _shared(tmp: Scratch, texts: DataFrame, own: DataFrame, rule: NearRule) -> DataFrame:
    """node, shared, m0, m1, …: how many of a node's shingles other components have too, and a bitmap of these."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor()
        for part in small(batches, 256):
            raw = pa.array([unpack.decompress(v) if v else b"" for v in part.column("body").to_pylist()], pa.binary())
            sets = [s.view(np.int64) for s in _sets(rule, raw.cast(pa.string()))]
            yield pa.RecordBatch.from_arrays(
                [part.column("node"), part.column("component"), pa.array(sets, pa.list_(pa.int64()))],
                names=["node", "component", "shingles"],
            )

    rows = texts.join(own, "node").select("node", "component", "body")
    rows = rows.mapInArrow(run, "node long, component long, shingles array<long>")
    rows = rows.select("node", "component", F.explode("shingles").alias("shingle"))
    same = Window.partitionBy("shingle")
    marks = [
        F.bit_or(F.expr(f"IF((shingle >> 6) & {_MARKS - 1} = {i}, shiftleft(1L, CAST(shingle & 63 AS INT)), 0L)")).alias(f"m{i}")
        for i in range(_MARKS)
    ]
    parts = []
    for i in range(_PARTS):
        part = rows.where(f"((shingle >> 10) & {_PARTS - 1}) = {i}")
        part = part.withColumn("first", F.min("component").over(same)).withColumn("last", F.max("component").over(same))
        part = part.where("first <> last").select("node", "shingle").repartition("node")
        parts.append(tmp.store(part.groupBy("node").agg(F.count("*").alias("shared"), *marks)))
    total = [F.bit_or(f"m{i}").alias(f"m{i}") for i in range(_MARKS)]
    return reduce(DataFrame.union, parts).groupBy("node").agg(F.sum("shared").alias("shared"), *total)


def _could_join(mixed: DataFrame, rule: NearRule) -> DataFrame:
    """Pairs (a, b) of nodes of different components that share a bucket and whose bounds allow a link.

    A link needs ``denominator * both >= numerator * (n + xn - both)``.
    """
    renamed = {c: f"x{c}" for c in ("node", "component", "n", "shared", *(f"m{i}" for i in range(_MARKS)))}
    few = mixed.where("component <> main").select("bucket", *(F.col(c).alias(x) for c, x in renamed.items()))
    lacks = " + ".join(f"bit_count(m{i} & ~xm{i})" for i in range(_MARKS))
    xlacks = " + ".join(f"bit_count(xm{i} & ~m{i})" for i in range(_MARKS))
    enough = f">= {rule.numerator} * (n + xn)"
    both = rule.numerator + rule.denominator
    return (
        few.join(mixed, "bucket")
        .where("xcomponent <> component AND (component = main OR xnode < node)")
        .where("xnode NOT IN (lo, hi) AND node NOT IN (lo, hi)")
        .where(f"{both} * least(shared, xshared) {enough}")
        .where(f"{both} * (shared - ({lacks})) {enough} AND {both} * (xshared - ({xlacks})) {enough}")
        .select(F.least("xnode", "node").alias("a"), F.greatest("xnode", "node").alias("b"))
        .distinct()
    )


def _apart(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """Pairs whose ends are in different components, with these."""
    for end in ("a", "b"):
        own = labels.select(F.col("node").alias(end), F.col("component").alias(f"c{end}"))
        pairs = pairs.join(own, end, "left").withColumn(f"c{end}", F.coalesce(f"c{end}", end))
    return pairs.where("ca <> cb")


def near_duplicates(
    df: DataFrame,
    rule: NearRule = NearRule(),  # noqa: B008
    id_col: str = "doc_id",
    text_col: str = "text",
    unique_ids: bool = False,
) -> DataFrame:
    """One row per row of ``df``: doc_id, n_shingles, component_id, kept.

    Words are runs of bytes other than white space, A-Z in lower case; a set
    holds the distinct shingles of ``rule.words`` words, or the whole sequence if
    it has fewer. Shingles are compared as 64-bit hashes, sets folded by 128-bit
    keys.

    - Null, empty and blank texts have no shingles and are linked with nothing.
    - component_id is the smallest id of the component; ids may repeat or be
      null (null only if all ids of the component are). A row without shingles
      is a component of its own.
    - kept marks one row of each component: the first by id (nulls last), then
      by place in the table.
    - Other columns of ``df`` are ignored, whatever their names.
    - unique_ids says that no id comes twice or is null; texts are then found by
      their ids, without making the sets of all texts again.
    """
    spark = prepare(df.sparkSession)
    with Scratch(spark) as tmp:
        return stored(_near_duplicates(tmp, df, rule, id_col, text_col, unique_ids))


def _near_duplicates(
    tmp: Scratch,
    df: DataFrame,
    rule: NearRule,
    id_col: str,
    text_col: str,
    unique_ids: bool,
) -> DataFrame:
    sketch = tmp.store(_sketch(df, rule, id_col, text_col))
    full = sketch.where("n_shingles > 0")

    # Equal sets: the first row stands for all.
    classes = tmp.store(full.groupBy("key1", "key2").agg(F.min("row").alias("node"), F.count("*").alias("rows")))
    several = classes.where("rows > 1")
    repeats = full.select("row", "key1", "key2").join(hint_if_small(several), ["key1", "key2"]).where("row <> node")
    repeats = tmp.store(repeats.select("row"))
    size = measured_bytes(repeats)

    # Buckets of at least two nodes, and their stars. The ends are written first, so that not both shuffles stand on disk.
    members = _nodes(full, repeats, size).select("node", F.explode("buckets").alias("bucket"))
    ends = members.groupBy("bucket").agg(F.min("node").alias("lo"), F.max("node").alias("hi"))
    ends = tmp.store(ends.where("lo < hi"))
    members = tmp.store(members.join(ends, "bucket"))
    # The buckets are most of the sketch.
    wide, sketch = sketch, tmp.store(sketch.drop("buckets"))
    tmp.remove(wide)
    tmp.remove(ends)
    nodes = _nodes(sketch.where("n_shingles > 0"), repeats, size)
    if size > BROADCAST_BYTES:
        nodes = tmp.store(nodes)
    sigs = nodes.select("node", "sig")
    stars = (
        members.select(F.col("lo").alias("a"), F.col("node").alias("b"))
        .union(members.select(F.col("node").alias("a"), F.col("hi").alias("b")))
        .where("a <> b")
        .distinct()
    )
    likely = tmp.store(_test(stars, sigs, rule))

    involved = likely.select(F.col("a").alias("node")).union(likely.select(F.col("b").alias("node"))).distinct()
    texts_of = partial(_texts_by_id, id_col=id_col) if unique_ids else partial(_texts_of, rule=rule)
    texts = texts_of(tmp, df, text_col=text_col, nodes=nodes, involved=involved)
    first = likely.groupBy("b").agg(F.max_by("a", F.struct("matches", -F.col("a"))).alias("a"))
    links = tmp.store(_confirm(first.select("a", "b"), texts, rule))
    labels = components(links, tmp)

    # Likely pairs that could still join two components.
    later = _apart(likely.select("a", "b"), labels).join(first, ["a", "b"], "left_anti").select("a", "b")
    links = tmp.store(links.union(_confirm(later, texts, rule)))
    labels = components(links, tmp)

    # Buckets whose nodes are still in several components.
    own = labels.select("node", "component")
    placed = members.select("bucket", "node", "lo", "hi").join(own, "node", "left")
    placed = placed.withColumn("component", F.coalesce("component", "node"))
    sizes = placed.groupBy("bucket", "component").agg(F.count("*").alias("n"))
    main = sizes.groupBy("bucket").agg(
        F.max_by("component", F.struct("n", -F.col("component"))).alias("main"), F.count("*").alias("components")
    )
    mixed = tmp.store(placed.join(main.where("components > 1").select("bucket", "main"), "bucket"))
    tmp.remove(members)
    own = tmp.store(mixed.select("node", "component").distinct())
    others = own.select("node").join(texts.select("node"), "node", "left_anti")
    texts = texts.union(texts_of(tmp, df, text_col=text_col, nodes=nodes, involved=others))
    bounds = _shared(tmp, texts, own, rule).join(nodes.select("node", F.col("n_shingles").alias("n")), "node")
    bounds = tmp.store(bounds.where(f"{rule.denominator} * shared >= {rule.numerator} * n"))
    unsettled = tmp.store(_test(_could_join(tmp.store(mixed.join(bounds, "node")), rule), sigs, rule))
    links = tmp.store(links.union(_confirm(unsettled.select("a", "b"), texts, rule)))
    labels = components(links, tmp)

    # Back to rows, by way of the set keys.
    group = classes.join(labels, "node", "left").select(
        "key1", "key2", F.coalesce("component", "node").alias("component")
    )
    rows = sketch.select("row", "doc_id", "n_shingles", "key1", "key2").join(group, ["key1", "key2"], "left")
    rows = rows.withColumn("component", F.when(F.col("n_shingles") > 0, F.col("component")).otherwise(F.col("row")))
    rows = tmp.store(rows.select("row", "doc_id", "n_shingles", "component"))
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "row")
    best = tmp.store(rows.groupBy("component").agg(F.min(order).alias("best")))
    return rows.join(best, "component").select(
        "doc_id",
        "n_shingles",
        F.col("best.doc_id").alias("component_id"),
        (F.col("best.row") == F.col("row")).alias("kept"),
        "row",
    )


def _nodes(rows: DataFrame, repeats: DataFrame, size: int) -> DataFrame:
    """The rows that stand for their classes: all but ``repeats``, which measure so many bytes."""
    return rows.join(hint_if_small(repeats, size), "row", "left_anti").withColumnRenamed("row", "node")


def _texts_by_id(tmp: Scratch, df: DataFrame, id_col: str, text_col: str, nodes: DataFrame, involved: DataFrame) -> DataFrame:
    """(node, body) of the nodes that have pairs to confirm, where no id comes twice."""
    wanted = tmp.store(nodes.select("node", "doc_id").join(involved, "node", "left_semi"))
    found = df.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).join(hint_if_small(wanted), "doc_id")
    return tmp.store(_packed(found))


def _texts_of(tmp: Scratch, df: DataFrame, rule: NearRule, text_col: str, nodes: DataFrame, involved: DataFrame) -> DataFrame:
    """(node, body) of the nodes that have pairs to confirm; texts are found by their set keys."""
    wanted = tmp.store(nodes.select("node", "key1", "key2").join(involved, "node", "left_semi"))
    found = _bodies(df, rule, text_col).join(hint_if_small(wanted), ["key1", "key2"])
    return tmp.store(found.select("node", "body").dropDuplicates(["node"]))
