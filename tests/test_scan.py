import fnmatch
import os

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gleanery.operators.project import conform, normalize
from gleanery.operators.union import union_by_name
from gleanery.session import prepare
from gleanery.sources.files import file_manifest, glob_match, load_selected, select_files
from gleanery.sources.scan import extract_bytes, read_table, scan_raw
from tests.conftest import plan_of


def test_scan_takes_the_union_of_columns_in_file_order(spark, path):
    pq.write_table(pa.table({"id": ["c", "d"], "data": [b"3", b"4"], "note": ["x", "y"]}), f"{path}/b.parquet")
    pq.write_table(pa.table({"id": ["a", "b"], "data": [b"1", b"2"]}), f"{path}/a.parquet")
    os.mkdir(f"{path}/nested")
    pq.write_table(pa.table({"id": ["z"], "data": [b"9"]}), f"{path}/nested/c.parquet")
    rows = scan_raw(spark, path).orderBy("src_file", "src_row").collect()
    assert [(r["id"], r["note"]) for r in rows] == [("a", None), ("b", None), ("c", "x"), ("d", "y")]
    assert scan_raw(spark, f"{path}/a.parquet").count() == 2


def test_scan_checks_columns_before_any_work(spark, path):
    pq.write_table(pa.table({"key": ["a"], "data": [b"1"]}), f"{path}/a.parquet")
    with pytest.raises(ValueError, match=r"'id'.*\['key', 'data'\]"):
        scan_raw(spark, path)
    with pytest.raises(ValueError, match="'blob'"):
        scan_raw(spark, path, "key", "blob")
    with pytest.raises(FileNotFoundError):
        scan_raw(spark, f"{path}/nothing")
    with pytest.raises(FileNotFoundError):
        read_table(spark, f"{path}/nothing")


def test_bytes_of_cells(spark):
    df = spark.createDataFrame(
        [
            (bytearray(b"p"), (bytearray(b""), "f", bytearray(b"d")), [1, -1, 0], "text", [1.0]),
            (None, (None, "f", bytearray(b"d")), [1, None], None, None),
            (bytearray(b""), None, [], "x", []),
        ],
        "plain binary, cell struct<bytes:binary,path:string,data:binary>, small array<tinyint>, words string, floats array<float>",
    )
    got = df.select(*[extract_bytes(F.col(c), df.schema[c].dataType).alias(c) for c in df.columns]).collect()
    assert [r["plain"] for r in got] == [b"p", None, b""]
    assert [r["cell"] for r in got] == [b"", b"d", None]
    assert [r["small"] for r in got] == [b"\x01\xff\x00", None, b""]
    assert all(r["words"] is None and r["floats"] is None for r in got)


def test_normalize(spark):
    df = spark.createDataFrame([("", bytearray(b"1"), "p"), ("a", None, None), (None, None, None)], "id string, data binary, file_path string")
    empty, a, none = normalize(df).collect()
    assert (empty["source_id"], empty["file_name"], empty["file_path"]) == ("", "", "p")
    assert len(empty["id"]) == 36
    assert (a["id"], a["file_name"], a["file_path"]) == ("a", "a", None)
    assert none["id"] is None
    assert normalize(df.drop("file_path")).first()["file_path"] == ""
    numbers = normalize(spark.createDataFrame([(7, bytearray(b"x"))], "n bigint, data binary"), "n")
    assert numbers.first()["id"] == "7"


def test_conform_fails_loudly_on_a_bad_value(spark):
    schema = T.StructType([T.StructField("n", T.IntegerType()), T.StructField("gone", T.StringType())])
    df = spark.createDataFrame([("1", 2)], "n string, other int")
    assert conform(df, schema).first().asDict() == {"n": 1, "gone": None}
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        conform(spark.createDataFrame([("x",)], "n string"), schema).collect()


def test_filters_reach_the_scan(spark, path):
    spark.range(100).selectExpr("id", "id % 5 AS m", "cast(id AS string) AS s").write.parquet(f"{path}/t")
    df = read_table(spark, f"{path}/t", ["id"], [("m", "in", [1, 2]), ("id", ">=", 50)])
    assert df.count() == 20
    plan = plan_of(df)
    assert "PushedFilters: [" in plan and "GreaterThanOrEqual(id,50)" in plan and "In(m" in plan
    assert "s#" not in plan
    assert read_table(spark, f"{path}/t", None, [[("m", "=", 0)], [("m", "not in", [1, 2, 3])]]).count() == 40
    with pytest.raises(ValueError):
        read_table(spark, f"{path}/t", None, [("m", "like", 1)])


def test_glob_match_is_fnmatch(spark):
    names = ["a/b.parquet", "a/b/c.parquet", "a.md", ".gitattributes", "x[1].json", "data/train/s-1.json", "new\nline.md"]
    for pattern in ["*.md", "a/*", "data/*/s-?.json", "x[[]1].json", "[!a]*", "a/b.parquet", "*"]:
        df = spark.createDataFrame([(n,) for n in names], "p string").where(glob_match(F.col("p"), [pattern]))
        assert {r["p"] for r in df.collect()} == {n for n in names if fnmatch.fnmatchcase(n, pattern)}, pattern


def test_manifest_and_selection(spark, path):
    for name in ("data/en/a.parquet", "data/en/sub/b.parquet", "data/fr/c.parquet"):
        os.makedirs(os.path.dirname(f"{path}/{name}"), exist_ok=True)
        pq.write_table(pa.table({"name": [name]}), f"{path}/{name}")
    open(f"{path}/read.md", "w").write("x")
    assert [r["rel_path"] for r in file_manifest(spark, path).collect()] == ["read.md"]
    files = file_manifest(spark, path, recursive=True)
    assert [r["rel_path"] for r in files.collect()] == ["data/en/a.parquet", "data/en/sub/b.parquet", "data/fr/c.parquet", "read.md"]
    assert all(r["length"] > 0 and r["modified_at"] for r in files.collect())
    chosen = select_files(files, "data/en", ignore=["*/sub/*"])
    assert [r["rel_path"] for r in chosen.collect()] == ["a.parquet"]
    chosen = select_files(files, "data/en", allow=["data/*.parquet"])
    assert [r["rel_path"] for r in chosen.collect()] == ["a.parquet", "sub/b.parquet", "data/fr/c.parquet"]
    assert load_selected(spark, chosen, path).count() == 3


def test_file_names_with_special_characters(spark, path):
    names = ["k=a%3Ab/p 1.parquet", "k=x y+z/é.parquet", "k=x y+z/!.parquet", "k=x y+z/ .parquet"]
    for name in names:
        os.makedirs(os.path.dirname(f"{path}/{name}"), exist_ok=True)
        pq.write_table(pa.table({"id": [name], "data": [b"x"]}), f"{path}/{name}")
    files = file_manifest(spark, path, recursive=True)
    assert {r["rel_path"] for r in files.collect()} == set(names)
    chosen = files.where(~F.col("rel_path").contains("!"))
    assert {r["id"] for r in load_selected(spark, chosen, path).collect()} == set(names) - {names[2]}
    rows = scan_raw(spark, f"{path}/k=x y+z").orderBy("src_file").collect()
    assert [r["id"] for r in rows] == [names[3], names[2], names[1]]


def test_union_checks_types(spark):
    a = spark.createDataFrame([(1, "x")], "n int, s string")
    b = spark.createDataFrame([("y", 2.0)], "s string, d double")
    both = union_by_name(a, b, a)
    assert both.columns == ["n", "s", "d"] and both.count() == 3
    with pytest.raises(TypeError):
        union_by_name(a, spark.createDataFrame([(1,)], "n bigint"))


def test_folders_are_listed_in_few_tasks(spark):
    """Not in a task per shard folder, unless the session says so."""
    name = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    assert int(prepare(spark).conf.get(name)) <= 4 * spark.sparkContext.defaultParallelism
    before = spark.conf.get(name)
    try:
        spark.conf.set(name, "7")
        assert prepare(spark).conf.get(name) == "7"
    finally:
        spark.conf.set(name, before)
