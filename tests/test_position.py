import random

import pytest
from pyspark.sql import functions as F

from gleanery.operators import position as P
from gleanery.operators import resume as R
from gleanery.operators.position import attach_shard, cap, running_totals, with_batch, with_position, with_shard
from gleanery.operators.resume import first_of_each, pending, pending_rows


@pytest.fixture(scope="module")
def places(spark):
    """Rows over files of very different sizes, one holding most, with gaps."""
    rng = random.Random(5)
    rows = []
    for file, size in (("f1", 3), ("f2", 6000), ("f3", 0), ("f4", 1), ("f5", 700), ("f6", 40)):
        rows += [(file, r) for r in sorted(rng.sample(range(size * 2 + 1), size))]
    order = list(range(len(rows)))
    rng.shuffle(order)
    df = spark.createDataFrame([(*rows[i], i + 1) for i in order], "src_file string, src_row bigint, want bigint")
    return df.repartition(7).cache()


@pytest.mark.parametrize("block_rows", [1, 13, 1000, 50_000])
def test_positions_are_dense_and_in_order(places, block_rows):
    rows = with_position(places, block_rows)
    assert rows.where("pos <> want").count() == 0
    assert rows.count() == places.count()


@pytest.mark.parametrize("n", [1, 7, 100, 10_000])
def test_batches_and_shards(places, n):
    assert with_batch(places, n).where(f"batch <> (want - 1) div {n} + 1").count() == 0
    rows = with_shard(places, n, start=12)
    assert rows.where(f"shard <> 12 + (want - 1) div {n}").count() == 0
    assert rows.where("want = 1").first()["shard_name"] == "shard-00012"


@pytest.mark.parametrize("limit", [0, 1 << 30])
@pytest.mark.parametrize("n", [1, 7, 100, 10_000])
def test_shards_attached_by_edges_are_the_same(places, n, limit, monkeypatch):
    monkeypatch.setattr("gleanery.session.BROADCAST_BYTES", limit)
    rows, count = attach_shard(places, n)
    assert count == places.count() == rows.count()
    assert rows.where(f"shard_index <> (want - 1) div {n}").count() == 0


def test_no_rows(places):
    none = places.where("want < 0")
    assert with_position(none).count() == 0
    assert attach_shard(none, 10)[1] == 0
    assert cap(none, 10, 5).count() == 0


@pytest.mark.parametrize("batches", [None, 0, 1, 25, 10_000])
def test_cap(places, batches):
    total = places.count()
    want = min(total, batches * 10) if batches else total
    rows = cap(places, 10, batches)
    assert rows.count() == want and rows.agg(F.max("want")).first()[0] == want


def test_running_totals(spark):
    df = spark.range(1, 301).selectExpr("'s' AS stage", "id % 3 AS run_seq", "id AS batch", "id AS total")
    got = running_totals(df, "stage", ("run_seq", "batch"), ("total",), F.floor(F.col("batch") / 10))
    so_far = 0
    for row in sorted(got.collect(), key=lambda r: (r["run_seq"], r["batch"])):
        so_far += row["total"]
        assert row["cum_total"] == so_far


def test_pending_keeps_repeats_and_knows_null(spark):
    rows = spark.createDataFrame(
        [("a", "f", 0), ("b", "f", 1), ("b", "f", 2), (None, "f", 3), ("", "f", 4)],
        "id string, src_file string, src_row bigint",
    )
    done = spark.createDataFrame([("a",), ("a",), ("x",)], "id string")
    assert sorted(r["src_row"] for r in pending(rows, done).collect()) == [1, 2, 3, 4]
    done = spark.createDataFrame([(None,), ("",)], "id string")
    assert sorted(r["src_row"] for r in pending(rows, done).collect()) == [0, 1, 2]


@pytest.mark.parametrize("limit", [1 << 30, 2000, 100, 0])
def test_every_way_to_leave_out_rows_agrees(spark, places, limit):
    # One key holds a third of the rows; small limits split files into groups and a file into spans.
    rows = places.withColumn("id", F.when(F.col("want") % 3 == 0, "hot").otherwise(F.col("want").cast("string")))
    done = rows.where("want <= 100 AND want % 3 = 1").select("id").unionAll(spark.sql("SELECT 'hot'"))
    want = {r["want"] for r in rows.collect() if r["id"] != "hot" and not (r["want"] <= 100 and r["want"] % 3 == 1)}
    got = [r["want"] for r in pending_rows(rows, done, limit=limit).collect()]
    assert len(got) == len(want) and set(got) == want


def test_pending_intervals_are_runs_within_blocks(spark, places):
    done = places.where("want % 5 = 0").select(F.col("want").cast("string").alias("id"))
    rows = places.withColumn("id", F.col("want").cast("string"))
    runs = R.pending_intervals(rows, done).collect()
    todo = {(r["src_file"], r["src_row"]) for r in rows.collect() if r["want"] % 5}
    covered = {(r["src_file"], x) for r in runs for x in range(r["lo"], r["hi"] + 1)}
    assert todo <= covered and all(r["lo"] // R.BLOCK_ROWS == r["hi"] // R.BLOCK_ROWS == r["block"] for r in runs)
    places_of = {(r["src_file"], r["src_row"]) for r in places.collect()}
    assert (covered & places_of) == todo


def test_first_of_each(spark, places):
    rows = places.withColumn("id", F.when(F.col("want") % 3 == 0, "hot").when(F.col("want") != 4, F.col("want").cast("string")))
    got = {r["want"] for r in first_of_each(rows).collect()}
    assert got == {w for w in range(1, places.count() + 1) if w % 3 or w == 3}


def test_block_of_rows_is_never_one_task(spark):
    df = spark.range(200_000).selectExpr("'one' AS src_file", "id AS src_row")
    sizes = P.block_offsets(df, 50_000).collect()
    assert sorted(r["block_offset"] for r in sizes) == [0, 50_000, 100_000, 150_000]
