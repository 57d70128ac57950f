"""Approximate nearest neighbours by cross-polytope hashing.

A fast pseudo-rotation (three rounds of random signs and a Hadamard transform)
turns a unit vector; its bucket is the nearest signed axis. A table's bucket
joins the axis of one rotation with that of a second one on a few coordinates.
Queries look into the buckets of the best-scoring pairs of axes of every table
until these hold a number of vectors, and all vectors met are compared exactly.
That number is measured at every size: some queries are compared with the whole
table, and where their neighbours lie in the order of the buckets tells how far
to look for the wanted recall. Where that costs as much as comparing every query
with the whole table, as with vectors that have no near ones, this is done.

Equal vectors are one class with its smallest ids, so copies cost nothing.
Buckets are split into chunks of a bounded number of classes; each chunk is one
small matrix product, from which only the best few of each query leave.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gleanery.session import Scratch, prepare, stored

# Classes of a bucket that are compared at once, and queries of an exact pass.
CHUNK = 4096
QUERY_BLOCK = 2048
# Queries that are compared with all rows to measure how far to look.
SAMPLE = 512
# Comparisons that take about as long as sending a query to one bucket.
PROBE_COST = 100


def _hadamard(x: np.ndarray) -> np.ndarray:
    rows, width = x.shape
    step = 1
    while step < width:
        pairs = x.reshape(rows, width // (2 * step), 2, step)
        x = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], axis=2).reshape(rows, width)
        step *= 2
    return x / np.sqrt(width)


def _rotated(unit: np.ndarray, signs: np.ndarray) -> np.ndarray:
    """Coordinates along the signed axes of a rotation: the positive ones, then the negative ones."""
    for s in signs:
        unit = _hadamard(unit * s)
    return np.concatenate([unit, -unit], axis=1)


class CrossPolytope:
    def __init__(self, dim: int, tables: int, second_axes: int, seed: int) -> None:
        self.dim, self.tables, self.second = dim, tables, second_axes
        self.width = 1 << max(1, dim - 1).bit_length()
        rng = np.random.default_rng(seed)
        self.signs = rng.choice(np.array([-1.0, 1.0]), (tables, 2, 3, self.width))

    def _axes(self, vectors: np.ndarray, table: int) -> tuple[np.ndarray, np.ndarray]:
        unit = np.zeros((len(vectors), self.width))
        unit[:, : self.dim] = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
        one, two = (_rotated(unit, self.signs[table, k]) for k in (0, 1))
        half = self.second // 2
        return one, np.concatenate([two[:, :half], two[:, self.width : self.width + half]], axis=1)

    def buckets(self, vectors: np.ndarray, table: int) -> np.ndarray:
        one, two = self._axes(vectors, table)
        return one.argmax(axis=1) * self.second + two.argmax(axis=1)

    def probed(self, vectors: np.ndarray, table: int, held: np.ndarray, visits: int) -> tuple[np.ndarray, np.ndarray]:
        """(vector, bucket) of the buckets whose two axes are together nearest, until they hold ``visits`` rows."""
        order, rows = self._order(vectors, table, held)
        return_rows, at = np.nonzero((np.cumsum(rows, axis=1) - rows < visits) & (rows > 0))
        return return_rows, order[return_rows, at]

    def ahead(self, vectors: np.ndarray, table: int, held: np.ndarray) -> np.ndarray:
        """Rows that each vector meets before it looks into each bucket."""
        order, rows = self._order(vectors, table, held)
        met = np.empty_like(rows)
        np.put_along_axis(met, order, np.cumsum(rows, axis=1) - rows, axis=1)
        return met

    def _order(self, vectors: np.ndarray, table: int, held: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        one, two = self._axes(vectors, table)
        loss = (one.max(axis=1, keepdims=True) - one)[:, :, None] ** 2
        loss = loss + (two.max(axis=1, keepdims=True) - two)[:, None, :] ** 2
        order = np.argsort(loss.reshape(len(vectors), -1), axis=1, kind="stable")
        return order, held[order]


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return np.asarray(column.flatten(), dtype=np.float64).reshape(-1, dim)


def _hashed(
    batches: Iterator[pa.RecordBatch], lsh: CrossPolytope, held: np.ndarray | None = None, visits: int = 0
) -> Iterator[pa.RecordBatch]:
    """Each vector with its bucket in every table or, given how many rows buckets hold, with those to look into."""
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            part = batch.slice(at, 256)
            vectors = _matrix(part.column("vec"), lsh.dim)
            for table in range(lsh.tables):
                if held is None:
                    rows, buckets = np.arange(len(vectors)), lsh.buckets(vectors, table)
                else:
                    rows, buckets = lsh.probed(vectors, table, held[table], visits)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(buckets.astype(np.int64) * lsh.tables + table),
                        part.column("cls").take(pa.array(rows)),
                        part.column("vec").take(pa.array(rows)),
                    ],
                    names=["bucket", "cls", "vec"],
                )


def _best(classes: np.ndarray, cosine: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` classes of largest cosine in each row, smaller numbers first among equals, and their cosines."""
    classes = np.broadcast_to(classes, cosine.shape)
    if cosine.shape[1] > 4 * k:
        least = np.partition(cosine, -k, axis=1)[:, -k]
        if not np.isnan(least).any():
            # Sorted are those only that are not below the k-th, with all its equals.
            rows, at = np.nonzero(cosine >= least[:, None])
            order = np.lexsort((classes[rows, at], -cosine[rows, at], rows))
            first = np.searchsorted(rows, np.arange(len(cosine)))
            at = at[order[first[:, None] + np.arange(k)]]
            return np.take_along_axis(classes, at, axis=1), np.take_along_axis(cosine, at, axis=1)
    at = np.lexsort((classes, -cosine), axis=1)[:, :k]
    return np.take_along_axis(classes, at, axis=1), np.take_along_axis(cosine, at, axis=1)


def _cosine(q: np.ndarray, v: np.ndarray) -> np.ndarray:
    return (q @ v.T) / (np.linalg.norm(q, axis=1)[:, None] * np.linalg.norm(v, axis=1))


def _scored(queries: np.ndarray, classes: np.ndarray, cosine: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(np.repeat(queries, classes.shape[1])), pa.array(classes.ravel()), pa.array(cosine.ravel())],
        names=["query", "cls", "score"],
    )


def _compared(batches: Iterator[pa.RecordBatch], dim: int, k: int) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by bucket and chunk, classes before queries."""
    key, classes, vectors = None, [], []
    for batch in batches:
        if not batch.num_rows:
            continue
        bucket, chunk, query, cls = (np.asarray(batch.column(c)) for c in ("bucket", "chunk", "query", "cls"))
        matrix = _matrix(batch.column("vec"), dim)
        cut = np.flatnonzero((bucket[1:] != bucket[:-1]) | (chunk[1:] != chunk[:-1]) | (query[1:] != query[:-1])) + 1
        for a, b in zip([0, *cut.tolist()], [*cut.tolist(), len(bucket)], strict=True):
            here = (int(bucket[a]), int(chunk[a]))
            if here != key:
                key, classes, vectors = here, [], []
            if not query[a]:
                classes.append(cls[a:b])
                vectors.append(matrix[a:b])
            elif classes:
                found, known = np.concatenate(classes), np.concatenate(vectors)
                for at in range(a, b, 256):
                    end = min(b, at + 256)
                    yield _scored(cls[at:end], *_best(found, _cosine(matrix[at:end], known), k))


def _exactly(batches: Iterator[pa.RecordBatch], ids: np.ndarray, vectors: np.ndarray, dim: int, k: int) -> Iterator[pa.RecordBatch]:
    """The ``k`` nearest of all rows of a task for each of ``ids``."""
    classes, cosine = np.empty((len(ids), 0), dtype=np.int64), np.empty((len(ids), 0))
    for batch in batches:
        for at in range(0, batch.num_rows, CHUNK):
            part = batch.slice(at, CHUNK)
            more = _best(np.asarray(part.column("cls")), _cosine(vectors, _matrix(part.column("vec"), dim)), k)
            classes, cosine = np.concatenate([classes, more[0]], axis=1), np.concatenate([cosine, more[1]], axis=1)
            classes, cosine = _best(classes, cosine, k)
    yield _scored(ids, classes, cosine)


def _top(found: DataFrame, k: int) -> DataFrame:
    found = found.groupBy("query", "cls").agg(F.max("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "cls"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).drop("rank")


def _all_compared(tmp: Scratch, asked: DataFrame, classes: DataFrame, dim: int, k: int) -> DataFrame:
    """query, cls, score: the ``k`` nearest of all classes for each class of ``asked``."""
    n = 1 + asked.count() // QUERY_BLOCK
    blocks = asked.select(F.pmod(F.xxhash64("cls"), F.lit(n)).alias("block"), "cls", "vec")
    found = []
    for block in range(n):
        rows = blocks.where(F.col("block") == block).collect()
        if rows:
            ids = np.array([r["cls"] for r in rows])
            vectors = np.array([r["vec"] for r in rows], dtype=np.float64)
            exact = classes.select("cls", "vec").mapInArrow(
                partial(_exactly, ids=ids, vectors=vectors, dim=dim, k=k), "query long, cls long, score double"
            )
            found.append(tmp.store(_top(exact, k)))
    # Tables of one folder each: read together, so that a plan does not grow with their number.
    paths = [p for f in found for p in f.inputFiles()]
    spark, schema = classes.sparkSession, "query long, cls long, score double"
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def _far_enough(
    tmp: Scratch, asked: DataFrame, classes: DataFrame, lsh: CrossPolytope, held: np.ndarray, k: int, recall: float, least: int
) -> int | None:
    """Rows to meet in each table, ``least`` or more, so that sampled queries meet ``recall`` of their ``k`` nearest.

    None if comparing a query with all rows costs no more.
    """
    sample = tmp.store(asked.orderBy(F.xxhash64("vec"), "cls").limit(SAMPLE))
    nearest_ones = _all_compared(tmp, sample, classes, lsh.dim, k + 1).where("query <> cls")
    rank = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "cls"))
    nearest_ones = nearest_ones.withColumn("rank", rank).where(F.col("rank") <= k).join(classes.select("cls", "vec"), "cls")
    pairs = nearest_ones.join(sample.select(F.col("cls").alias("query"), F.col("vec").alias("query_vec")), "query")
    pairs = pairs.select("query_vec", "vec").collect()
    if not pairs:
        return None
    one, other = (np.array([r[c] for r in pairs], dtype=np.float64) for c in ("query_vec", "vec"))
    before = np.full(len(pairs), np.iinfo(np.int64).max)
    for table in range(lsh.tables):
        buckets = lsh.buckets(other, table)
        for at in range(0, len(pairs), 256):
            met = lsh.ahead(one[at : at + 256], table, held[table])
            here = met[np.arange(len(met)), buckets[at : at + 256]]
            before[at : at + 256] = np.minimum(before[at : at + 256], here)
    visits = max(least, 1 + int(np.sort(before)[max(1, int(np.ceil(recall * len(before)))) - 1]))
    buckets = np.mean([(lsh.ahead(one[:256], t, held[t]) < visits)[:, held[t] > 0].sum(axis=1) for t in range(lsh.tables)])
    cost = lsh.tables * (visits + PROBE_COST * buckets)
    return visits if cost < held[0].sum() else None


def _probed(
    tmp: Scratch,
    asked: DataFrame,
    classes: DataFrame,
    index: DataFrame,
    sizes: DataFrame,
    lsh: CrossPolytope,
    held: np.ndarray,
    visits: int,
    k: int,
) -> DataFrame:
    """query, cls, score: the ``k`` + 1 nearest of the classes that each class of ``asked`` meets in the tables."""
    looks = asked.mapInArrow(partial(_hashed, lsh=lsh, held=held, visits=visits), index.schema)
    sizes = F.broadcast(sizes.select("bucket", F.ceil(F.col("held") / CHUNK).cast("int").alias("chunks")))
    index = index.join(sizes, "bucket").withColumn("chunk", F.pmod(F.xxhash64("cls"), F.col("chunks")).cast("int"))
    looks = looks.join(sizes, "bucket").withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    met = (
        index.select("bucket", "chunk", F.lit(False).alias("query"), "cls", "vec")
        .union(looks.select("bucket", "chunk", F.lit(True).alias("query"), "cls", "vec"))
        .repartition("bucket", "chunk")
        .sortWithinPartitions("bucket", "chunk", "query")
        .mapInArrow(partial(_compared, dim=lsh.dim, k=k + 1), "query long, cls long, score double")
    )
    found = tmp.store(_top(met, k + 1))
    enough = found.groupBy("query").agg(F.count("*").alias("n")).where(F.col("n") > k)
    short = tmp.store(asked.join(enough, F.col("query") == F.col("cls"), "left_anti"))
    return _top(found.union(_all_compared(tmp, short, classes, lsh.dim, k + 1)), k + 1)


def nearest(
    df: DataFrame,
    queries: DataFrame,
    k: int = 5,
    dim: int = 64,
    tables: int = 16,
    second_axes: int = 16,
    visits: int = 12_800,
    seed: int = 5,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    recall: float = 0.99,
) -> DataFrame:
    """query_id, rank, vec_id, score: for each row of ``queries`` the ``k`` nearest rows of ``df`` found, itself excluded.

    ``queries`` are rows of ``df``, told by their ids (longs). Nearness is the
    cosine in double precision, ties go to smaller ids. Vectors that are null or
    zero, of another length than ``dim``, or hold null or non-finite numbers
    take no part; neither do null ids. A row that repeats both id and vector
    counts once; a row with the query's id is never its neighbour. A query that
    met fewer than ``k`` candidates in the tables is compared with all rows, so
    it gets ``k`` if there are as many. Other columns are ignored.

    ``second_axes`` (a power of two up to twice the width) times twice the
    width is the number of buckets of a table; ``visits`` is how many rows a
    query meets at least in all tables together, before repeats are dropped. It
    is raised until up to 512 queries, chosen by hash and compared with all
    rows, meet ``recall`` of their neighbours; if that costs as much as
    comparing all queries with all rows, these are compared, and the result is
    exact.
    """
    spark = prepare(df.sparkSession)
    with Scratch(spark) as tmp:
        return stored(_nearest(tmp, df, queries, k, dim, tables, second_axes, visits, seed, id_col, vec_col, recall))


def _nearest(
    tmp: Scratch,
    df: DataFrame,
    queries: DataFrame,
    k: int,
    dim: int,
    tables: int,
    second_axes: int,
    visits: int,
    seed: int,
    id_col: str,
    vec_col: str,
    recall: float,
) -> DataFrame:
    lsh = CrossPolytope(dim, tables, second_axes, seed)

    def valid(rows: DataFrame) -> DataFrame:
        vec = F.col(vec_col)
        fine = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        rows = rows.where(F.col(id_col).isNotNull() & (F.size(vec) == dim) & fine & F.exists(vec, lambda x: x != 0))
        return rows.select(F.col(id_col).alias("id"), vec.alias("vec")).distinct()

    turn = F.row_number().over(Window.partitionBy("vec").orderBy("id"))
    few = valid(df).withColumn("turn", turn).where(F.col("turn") <= k + 1)
    classes = tmp.store(few.groupBy("vec").agg(F.min("id").alias("cls"), F.sort_array(F.collect_list("id")).alias("ids")))
    # One number may name several classes if ids repeat with different vectors.
    classes = tmp.store(classes.select(F.monotonically_increasing_id().alias("cls"), "vec", "ids"))
    asked = tmp.store(valid(queries).join(classes, "vec").select(F.col("id").alias("query_id"), "cls"))
    asked_classes = classes.join(asked.select("cls").distinct(), "cls", "left_semi").select("cls", "vec")

    vec_type = classes.schema["vec"].dataType.simpleString()
    schema = f"bucket long, cls long, vec {vec_type}"
    index = classes.select("cls", "vec").mapInArrow(partial(_hashed, lsh=lsh), schema)
    # Rows of each bucket: their number is bounded by tables and axes.
    sizes = tmp.store(index.groupBy("bucket").agg(F.count("*").alias("held")))
    held = np.zeros((tables, 2 * lsh.width * second_axes), dtype=np.int64)
    for row in sizes.collect():
        held[row["bucket"] % tables, row["bucket"] // tables] = row["held"]
    asked_classes = tmp.store(asked_classes)
    least = -(-visits // tables)
    enough = _far_enough(tmp, asked_classes, classes, lsh, held, k, recall, least)
    if enough is None:
        found = _all_compared(tmp, asked_classes, classes, dim, k + 1)
    else:
        found = _probed(tmp, asked_classes, classes, index, sizes, lsh, held, enough, k)
    result = found.join(classes.select("cls", F.explode("ids").alias("vec_id")), "cls")
    result = asked.withColumnRenamed("cls", "query").join(result, "query").where("vec_id <> query_id")
    result = result.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return result.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
