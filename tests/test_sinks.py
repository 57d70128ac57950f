import os
import shutil

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gleanery.schemas import QUARANTINE
from gleanery.sinks import shards as S
from gleanery.sinks.shards import merge_shards, next_shard, write_shards
from gleanery.sinks.tables import append_table, publish, read_conformed, write_quarantine, write_table

SCHEMA = T.StructType([T.StructField("n", T.LongType()), T.StructField("s", T.StringType())])


def numbers(spark, size, file="f"):
    return spark.range(size).repartition(5).selectExpr("id AS n", f"'{file}' AS src_file", "id AS src_row")


def files_of(folder):
    return sorted(
        os.path.relpath(os.path.join(d, f), folder) for d, _, fs in os.walk(folder) for f in fs if f.endswith(".parquet")
    )


def test_shards_are_numbered_over_runs(spark, path):
    out = f"{path}/out"
    assert next_shard(spark, out) == 1
    assert write_shards(numbers(spark, 25), out, SCHEMA, 10) == 3
    assert write_shards(numbers(spark, 10), out, SCHEMA, 10) == 1
    assert write_shards(numbers(spark, 0), out, SCHEMA, 10) == 0
    assert write_shards(numbers(spark, 1), out, SCHEMA, 10, "gzip") == 1
    found = files_of(out)
    assert [os.path.dirname(f) for f in found] == [f"shard=0000{i}" for i in range(1, 6)]
    assert next_shard(spark, out) == 6
    for i, want in enumerate([range(10), range(10, 20), range(20, 25), range(10), range(1)]):
        assert pq.read_table(f"{out}/{found[i]}").column("n").to_pylist() == list(want)
    assert spark.read.parquet(out).columns == ["n", "s", "shard"]


def test_other_names_are_ignored(spark, path):
    for name in ("shard-00007.parquet", "shard-x.parquet", "other.parquet"):
        pq.write_table(pa.table({"n": [1]}), f"{path}/{name}")
    assert next_shard(spark, path) == 8
    shutil.rmtree(path + "/none", ignore_errors=True)
    os.mkdir(f"{path}/none")
    pq.write_table(pa.table({"n": [1]}), f"{path}/none/shard-x.parquet")
    assert next_shard(spark, f"{path}/none", start=4) == 4


def test_an_interrupted_write_is_replaced(spark, path):
    write_shards(numbers(spark, 10), path + "/out", SCHEMA, 10)
    for _ in range(2):
        write_shards(numbers(spark, 35), path + "/out", SCHEMA, 10, start=2)
    assert spark.read.parquet(path + "/out").count() == 45
    assert next_shard(spark, path + "/out") == 6


def test_many_shards_share_a_directory(spark, path):
    out = f"{path}/out"
    assert write_shards(numbers(spark, 95), out, SCHEMA, 2, ranges=True) == 48
    assert write_shards(numbers(spark, 5), out, SCHEMA, 2, ranges=True) == 3
    for _ in range(2):
        write_shards(numbers(spark, 4), out, SCHEMA, 2, start=52, ranges=True)
    assert sorted(os.listdir(out))[-3:] == ["shards=00001-00048", "shards=00049-00051", "shards=00052-00053"]
    rows = spark.read.parquet(out)
    assert rows.count() == 104 and rows.agg(F.max("shard")).first()[0] == 53
    assert rows.where("shard <= 48 AND shard <> n div 2 + 1").count() == 0
    # A shard is never spread over files.
    spread = rows.withColumn("f", F.col("_metadata.file_path")).groupBy("shard").agg(F.countDistinct("f").alias("k"))
    assert spread.where("k > 1").count() == 0


def test_shards_without_a_shuffle(spark, path):
    df = numbers(spark, 100)
    assert write_shards(df, f"{path}/out", SCHEMA, 10, one_file=False) == 10
    rows = spark.read.parquet(f"{path}/out")
    assert rows.count() == 100 and rows.where("shard <> n div 10 + 1").count() == 0


def test_merge_keeps_order_and_unites_columns(spark, path):
    src = f"{path}/src"
    os.mkdir(src)
    pq.write_table(pa.table({"a": [3, 4], "b": ["x", "y"]}), f"{src}/shard-00002.parquet")
    pq.write_table(pa.table({"a": [1, 2]}), f"{src}/shard-00001.parquet")
    pq.write_table(pa.table({"a": ["text"]}), f"{src}/other.parquet")
    assert merge_shards(spark, src, f"{path}/dst", "shard-*.parquet") == 1
    (file,) = files_of(f"{path}/dst")
    assert pq.read_table(f"{path}/dst/{file}").to_pydict() == {"a": [1, 2, 3, 4], "b": [None, None, "x", "y"]}
    with pytest.raises(Exception, match="CANNOT_MERGE|merge"):
        merge_shards(spark, src, f"{path}/dst2")
    with pytest.raises(FileNotFoundError):
        merge_shards(spark, src, f"{path}/dst3", "none-*.parquet")
    with pytest.raises(ValueError):
        merge_shards(spark, src, f"{src}/merged")
    with pytest.raises(ValueError):
        merge_shards(spark, src, f"{path}/dst4", "shard-*.parquet", T.StructType([T.StructField("a", T.LongType())]))
    schema = T.StructType([T.StructField("a", T.StringType()), T.StructField("b", T.StringType())])
    merge_shards(spark, src, f"{path}/dst5", "shard-*.parquet", schema)
    assert spark.read.parquet(f"{path}/dst5").dtypes[0] == ("a", "string")


@pytest.mark.parametrize("limit", [0, 1 << 30])
def test_merge_into_several_files(spark, path, limit, monkeypatch):
    monkeypatch.setattr("gleanery.session.BROADCAST_BYTES", limit)
    monkeypatch.setattr(S, "BLOCK_ROWS", 16)
    for i in range(6):
        pq.write_table(pa.table({"n": list(range(i * 100, i * 100 + 100))}), f"{path}/shard-0000{i}.parquet")
    count = merge_shards(spark, path, f"{path}-merged", target_bytes=os.path.getsize(f"{path}/shard-00000.parquet") * 2)
    found = files_of(f"{path}-merged")
    assert count == len(found) and 3 <= count <= 4
    parts = [pq.read_table(f"{path}-merged/{f}").column("n").to_pylist() for f in found]
    assert sum(parts, []) == list(range(600))
    assert max(map(len, parts)) <= 216


def test_write_replaces_and_takes_no_rows(spark, path):
    write_table(numbers(spark, 3), f"{path}/t", SCHEMA)
    write_table(numbers(spark, 0), f"{path}/t", SCHEMA)
    empty = spark.read.parquet(f"{path}/t")
    assert empty.count() == 0 and empty.schema == SCHEMA


def test_append_under_a_grown_schema(spark, path):
    append_table(numbers(spark, 2), f"{path}/t", T.StructType([SCHEMA["n"]]))
    append_table(spark.sql("SELECT 5L AS n, 'x' AS s, true AS extra"), f"{path}/t", SCHEMA)
    rows = read_conformed(spark, f"{path}/t", SCHEMA).orderBy("n").collect()
    assert [tuple(r) for r in rows] == [(0, None), (1, None), (5, "x")]


def test_publish(spark, path):
    write_shards(numbers(spark, 30), f"{path}/src", SCHEMA, 10)
    files = publish(f"{path}/src", f"{path}/dst", spark, file_filter=lambda rel: ~rel.contains("shard=00002"), partition_by=["shard"])
    assert files.count() == 2
    assert sorted(r["n"] for r in spark.read.parquet(f"{path}/dst").collect()) == [*range(10), *range(20, 30)]
    again = publish(f"{path}/src", f"{path}/dst", spark, patterns=["shard=00002/*"], partition_by=["shard"])
    assert [r["rel_path"].split("/")[0] for r in again.collect()] == ["shard=2"]
    assert sorted(r["n"] for r in spark.read.parquet(f"{path}/dst").collect()) == list(range(30))
    assert publish(f"{path}/src", f"{path}/none", spark, patterns=["*.csv"]).count() == 0
    assert not os.path.exists(f"{path}/none")
    with pytest.raises(FileNotFoundError):
        publish(f"{path}/gone", f"{path}/dst2", spark)


def test_quarantine_by_run(spark, path):
    rows = spark.createDataFrame([("a", "bad", "filter", "r1"), ("b", "bad", "label", "r1")], QUARANTINE)
    for _ in range(2):
        write_quarantine(rows, f"{path}/q")
    write_quarantine(spark.createDataFrame([("c", "bad", "filter", "r2")], QUARANTINE), f"{path}/q")
    assert sorted(r["id"] for r in spark.read.parquet(f"{path}/q").collect()) == ["a", "b", "c"]
