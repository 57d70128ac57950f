"""The shape of physical plans at the places that matter for large tables."""

import re

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from gleanery.operators.position import attach_shard, cap, with_position
from gleanery.operators.project import image_metadata, normalize, payload_error
from gleanery.operators.resume import pending_rows
from gleanery.sources.scan import read_stage, scan_raw
from tests.conftest import plan_of, png


@pytest.fixture(scope="module")
def images(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("images"))
    for f in range(4):
        rows = {"id": [f"r{f}{i}" for i in range(50)], "data": [png(9, 9) for _ in range(50)], "unused": ["x"] * 50}
        pq.write_table(pa.table(rows), f"{folder}/f{f}.parquet")
    return folder


def payload_exchanges(df, column="data"):
    """Exchanges whose rows carry the payload column."""
    lines = plan_of(df).splitlines()
    found = []
    for i, line in enumerate(lines):
        if re.search(r"[+:*\- ]Exchange ", line):
            below = "\n".join(lines[i + 1 : i + 3])
            if re.search(rf"\b{column}#", below):
                found.append(line.strip())
    return found


def test_scan_reads_only_what_is_needed(spark, images):
    plan = plan_of(normalize(scan_raw(spark, images)))
    assert "unused" not in plan


def test_positions_use_no_single_partition_over_rows(spark, images):
    df = with_position(scan_raw(spark, images))
    exchanges = payload_exchanges(df)
    assert exchanges and not any("SinglePartition" in e for e in exchanges)


def test_cap_moves_no_rows_and_skips_files(spark, images):
    df = cap(scan_raw(spark, images), 10, 7)
    assert df.count() == 70 and "Exchange" not in plan_of(df)
    df.collect()
    scan = df._jdf.queryExecution().executedPlan()
    while not scan.children().isEmpty():
        scan = scan.children().apply(0)
    assert scan.metrics().apply("numFiles").value() == 2


def files_read(df, column="data"):
    """Files opened by the scans of an executed plan that read ``column``."""
    df.collect()
    found = []

    def walk(node):
        if node.nodeName() == "AdaptiveSparkPlan":
            node = node.executedPlan()
        if node.nodeName().endswith("QueryStage"):
            node = node.plan()
        if node.nodeName().startswith("Scan") and re.search(rf"\b{column}#", node.toString()):
            found.append(node.metrics().apply("numFiles").value())
        children = node.children().iterator()
        while children.hasNext():
            walk(children.next())

    walk(df._jdf.queryExecution().executedPlan())
    return sum(found)


@pytest.mark.parametrize("limit", [1 << 30, 0])
def test_resume_opens_only_files_with_pending_rows_and_moves_no_payload(spark, images, limit):
    scan = scan_raw(spark, images)
    done = scan.where("src_file LIKE '%f0.parquet' OR src_file LIKE '%f1.parquet' OR src_row < 10").select("id")
    df = pending_rows(scan, done, limit=limit)
    assert not payload_exchanges(df) and "BroadcastHashJoin" in plan_of(df)
    assert df.count() == 80 and files_read(df) == 2
    assert pending_rows(scan, scan.select("id")).count() == 0


def test_shards_are_attached_in_place(spark, images):
    placed, rows = attach_shard(scan_raw(spark, images), 10)
    assert rows == 200 and not payload_exchanges(placed)


def test_model_is_above_the_anti_join_and_payload_test(spark, images):
    from gleanery.operators.infer import infer

    scan = scan_raw(spark, images)
    probed = image_metadata(normalize(pending_rows(scan, scan.where("src_row < 10").select("id"))))

    def factory():
        return lambda requests: ["x" for _ in requests]

    asked = infer(probed, factory, F.when(payload_error().isNull(), F.col("id")))
    plan = plan_of(asked.where("answer = 'x'"))
    assert plan.index("ArrowEvalPython") < plan.index("LeftSemi")
    assert plan.count("ask(") == 1 and plan.index("Filter") < plan.index("ask(")


def test_verdict_reaches_the_stage_scan(spark, path):
    spark.sql("SELECT 'a' AS id, 'YES' AS filter_result").write.parquet(f"{path}/t")
    assert "EqualTo(filter_result,YES)" in plan_of(read_stage(spark, f"{path}/t"))
