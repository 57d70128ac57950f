import os
from dataclasses import replace

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from gleanery import CurationConfig, run_filter, run_incremental, run_label, run_stages
from gleanery.functions.json_labels import embedded_object
from gleanery.plans import jobs
from gleanery.plans.jobs import attempts
from gleanery.plans.ledger import read_ledger
from gleanery.plans.reports import progress, run_stats
from gleanery.schemas import FILTER_OUTPUT, LABEL_OUTPUT
from gleanery.sources.scan import with_source
from gleanery.streaming.incremental import new_keys, places_of
from tests.conftest import png


def raw(folder, name, rows):
    os.makedirs(folder, exist_ok=True)
    ids, data = zip(*rows)
    pq.write_table(pa.table({"id": pa.array(ids, pa.string()), "data": pa.array(data, pa.binary())}), f"{folder}/{name}.parquet")


def model_of(answer, calls=None):
    """A model that gives ``answer``, or what the image says after ``=``."""

    def factory():
        def model(requests):
            if calls is not None:
                calls.add(len(requests))
            found = []
            for messages in requests:
                image = messages[-1]["content"][0]["image"]
                told = image.split(b"=", 1)[1].decode() if b"=" in image else answer
                if told == "fail":
                    raise RuntimeError("no memory")
                found.append(told)
            return found

        return model

    return factory


def quiet():
    def sleep(seconds):
        return None

    return sleep


@pytest.fixture
def cfg(path):
    return CurationConfig(root=path, batch_size=2, rows_per_shard=3)


def numbered(first, last):
    return [(f"r{i:03d}", png(10 + i, 5)) for i in range(first, last)]


def stats(run):
    return run.total, run.kept, run.skipped, run.errors


def ids(spark, cfg, stage="filter"):
    return sorted(r["id"] for r in spark.read.parquet(cfg.output_dir(stage)).select("id").collect())


def test_second_run_asks_nothing(spark, cfg):
    raw(cfg.raw_dir, "a", numbered(0, 7) + [("no", png(1, 1, b"=no")), ("junk", b"hello"), ("empty", b""), ("none", None)])
    calls = spark.sparkContext.accumulator(0)
    run = run_filter(spark, cfg, model_of("YES", calls))
    assert stats(run) == (11, 7, 1, 3) and calls.value == 8
    rows = spark.read.parquet(cfg.output_dir("filter"))
    assert rows.drop("shard").schema == FILTER_OUTPUT
    assert sorted(r["shard"] for r in rows.collect()) == [1, 1, 1, 2, 2, 2, 3, 3]
    no = rows.where("id = 'no'").first()
    assert (no["filter_result"], no["image_bytes"], no["width"]) == ("NO", None, 1)
    assert rows.where("image_bytes IS NULL").count() == 1
    assert rows.select("processed_at").distinct().count() == 1
    bad = spark.read.parquet(cfg.quarantine_dir).orderBy("id").collect()
    assert [(r["id"], r["error"].split("=")[0], r["stage"]) for r in bad] == [
        ("empty", "no image data for id", "filter"),
        ("junk", "undecodable image data for id", "filter"),
        ("none", "no image data for id", "filter"),
    ]
    again = run_filter(spark, cfg, model_of("YES", calls))
    assert stats(again) == (0, 0, 0, 0) and calls.value == 8
    assert rows.count() == spark.read.parquet(cfg.output_dir("filter")).count()


def test_repeats_within_a_run_and_new_files(spark, cfg):
    raw(cfg.raw_dir, "a", numbered(0, 3) + numbered(0, 2))
    assert run_filter(spark, cfg, model_of("yes")).total == 5
    raw(cfg.raw_dir, "b", numbered(1, 5))
    assert run_filter(spark, cfg, model_of("yes")).total == 2
    assert ids(spark, cfg) == ["r000", "r000", "r001", "r001", "r002", "r003", "r004"]
    assert spark.read.parquet(cfg.output_dir("filter")).agg(F.max("shard")).first()[0] == 3


def test_dedupe(spark, cfg):
    raw(cfg.raw_dir, "a", numbered(0, 3) + numbered(0, 2))
    run_filter(spark, replace(cfg, dedupe_ids=True), model_of("yes"))
    assert ids(spark, cfg) == ["r000", "r001", "r002"]


def test_cap_and_resume(spark, cfg):
    raw(cfg.raw_dir, "a", numbered(0, 3))
    raw(cfg.raw_dir, "b", numbered(3, 11))
    capped = replace(cfg, num_batches=2)
    assert run_filter(spark, capped, model_of("yes")).total == 4
    assert ids(spark, cfg) == ["r000", "r001", "r002", "r003"]
    assert run_filter(spark, capped, model_of("yes")).total == 4
    assert ids(spark, cfg)[-1] == "r007"
    assert run_filter(spark, replace(cfg, num_batches=0), model_of("yes")).total == 3
    got = progress(attempts(spark, cfg, "filter"), "filter").orderBy("run_seq", "batch").collect()
    assert [(r["run_seq"], r["batch"], r["total"], r["cum_total"]) for r in got] == [
        (1, 1, 2, 2),
        (1, 2, 2, 4),
        (2, 1, 2, 6),
        (2, 2, 2, 8),
        (3, 1, 2, 10),
        (3, 2, 1, 11),
    ]


def test_empty_and_missing_ids(spark, cfg):
    raw(cfg.raw_dir, "a", [("", png()), ("", png(4)), (None, png())])
    run = run_filter(spark, cfg, model_of("yes"))
    assert stats(run) == (3, 2, 0, 1)
    rows = spark.read.parquet(cfg.output_dir("filter")).collect()
    assert len({r["id"] for r in rows}) == 2 and all(len(r["id"]) == 36 and r["file_name"] == "" for r in rows)
    # Rows without an id are told apart by their place, so those of another file are still to do.
    raw(cfg.raw_dir, "b", [("", png()), (None, png()), ("x", png())])
    assert run_filter(spark, cfg, model_of("yes")).total == 3
    assert run_filter(spark, cfg, model_of("yes")).total == 0


def test_capped_runs_reach_every_row_without_id(spark, cfg):
    raw(cfg.raw_dir, "a", [("", png())] * 6)
    capped = replace(cfg, num_batches=1, batch_size=2)
    assert [run_filter(spark, capped, model_of("yes")).total for _ in range(4)] == [2, 2, 2, 0]
    assert spark.read.parquet(cfg.output_dir("filter")).count() == 6


def test_incremental_refuses_a_cap(spark, cfg):
    with pytest.raises(ValueError, match="max_files"):
        run_incremental(spark, replace(cfg, num_batches=1), model_of("yes"))


def test_brace_search_is_linear(spark):
    df = spark.range(1).select(F.repeat(F.lit("{"), 1_000_000).alias("s"))
    assert df.select(embedded_object(F.col("s")).alias("e")).first()["e"] == ""


def test_failed_rows_are_done_unless_asked_again(spark, cfg):
    raw(cfg.raw_dir, "a", [("ok", png()), ("bad", png(2, 2, b"=fail"))])
    run = run_filter(spark, cfg, model_of("yes"), sleep=quiet())
    assert stats(run) == (2, 1, 0, 1)
    assert spark.read.parquet(cfg.quarantine_dir).first()["error"] == "generation failed after 3 attempts"
    assert run_filter(spark, cfg, model_of("yes"), sleep=quiet()).total == 0
    assert run_filter(spark, replace(cfg, retry_failed=True), model_of("yes"), sleep=quiet()).total == 1


def test_a_run_lost_before_the_ledger_is_judged_anew(spark, cfg, monkeypatch):
    raw(cfg.raw_dir, "a", numbered(0, 4))

    def lost(*args):
        raise OSError("driver lost")

    with monkeypatch.context() as patch:
        patch.setattr(jobs, "record", lost)
        with pytest.raises(OSError):
            run_filter(spark, cfg, model_of("yes"))
    calls = spark.sparkContext.accumulator(0)
    run = run_filter(spark, cfg, model_of("yes", calls))
    assert run.total == 4 and calls.value == 4 and len(ids(spark, cfg)) == 4


@pytest.mark.parametrize("when", ["write_shards", "write_quarantine"])
def test_a_judged_run_is_finished_without_the_model(spark, cfg, monkeypatch, when):
    raw(cfg.raw_dir, "a", numbered(0, 7) + [("junk", b"x")])
    calls = spark.sparkContext.accumulator(0)

    def lost(*args, **kwargs):
        raise OSError("driver lost")

    with monkeypatch.context() as patch:
        patch.setattr(jobs, when, lost)
        with pytest.raises(OSError):
            run_filter(spark, cfg, model_of("yes", calls))
    raw(cfg.raw_dir, "b", numbered(7, 9))
    run = run_filter(spark, cfg, model_of("yes", calls))
    assert run.total == 2 and calls.value == 9
    assert ids(spark, cfg) == [f"r{i:03d}" for i in range(9)]
    rows = spark.read.parquet(cfg.output_dir("filter"))
    assert sorted(r["shard"] for r in rows.where("id <= 'r006'").collect()) == [1, 1, 1, 2, 2, 2, 3]
    assert spark.read.parquet(cfg.quarantine_dir).count() == 1
    assert sorted(r["status"] for r in read_ledger(spark, cfg).collect()) == ["done", "done", "judged", "judged"]


def test_label_stage(spark, cfg):
    texts = {
        "ok": '{"category":"food","is_professional":"yes"}',
        "prose": "nothing",
        "list": "[1]",
        "number": '{"category":1}',
        "broken": "fail",
    }
    raw(cfg.raw_dir, "a", [(k, png(5, 5, b"=" + t.encode())) for k, t in texts.items()])
    run_filter(spark, cfg, by_constant("YES"))
    run = run_label(spark, cfg, model_of("{}"), sleep=quiet())
    assert stats(run) == (5, 3, 0, 2)
    rows = {r["id"]: r for r in spark.read.parquet(cfg.output_dir("label")).collect()}
    assert spark.read.parquet(cfg.output_dir("label")).drop("shard").schema == LABEL_OUTPUT
    assert (rows["ok"]["category"], rows["ok"]["is_professional"], rows["ok"]["label_json"]) == ("food", True, texts["ok"])
    assert rows["prose"]["error"] == "No JSON object found: nothing" and rows["prose"]["label_json"] is None
    assert rows["broken"]["error"] == "generation failed after 3 attempts"
    assert all(r["image_bytes"] and r["filter_result"] == "YES" for r in rows.values())
    bad = {r["id"]: r["error"] for r in spark.read.parquet(cfg.quarantine_dir).collect()}
    assert bad == {"list": "label_not_an_object", "number": "label_type_error: category"}
    assert run_stats(attempts(spark, cfg, "label"), "label").first()["labelled_ok"] == 1
    assert run_label(spark, cfg, model_of("{}"), sleep=quiet()).total == 0


def by_constant(answer):
    def factory():
        def model(requests):
            return [answer for _ in requests]

        return model

    return factory


def test_label_reads_plain_shard_files_too(spark, cfg):
    raw(cfg.raw_dir, "a", numbered(0, 4))
    run_filter(spark, cfg, by_constant("YES"))
    plain = spark.read.parquet(cfg.output_dir("filter")).drop("shard").where("id = 'r000'").toArrow()
    for name, rid in (("shard-00009", "old"), ("other", "not a shard")):
        row = plain.set_column(0, "id", pa.array([rid]))
        pq.write_table(row, f"{cfg.output_dir('filter')}/{name}.parquet")
    assert run_label(spark, cfg, by_constant("{}")).kept == 5
    assert "old" in ids(spark, cfg, "label")
    raw(cfg.raw_dir, "b", numbered(4, 5))
    assert run_filter(spark, cfg, by_constant("YES")).first_shard == 10


def test_stages(spark, cfg):
    raw(cfg.raw_dir, "a", numbered(0, 2))
    assert run_stages(spark, cfg, by_constant("YES"), stage="label") == {"label": None}
    with pytest.raises(ValueError):
        run_stages(spark, cfg, by_constant("YES"), stage="both")
    report = run_stages(spark, cfg, by_constant('YES {"mood":"warm"}'))
    assert report["filter"].kept == 2 and report["label"].kept == 2
    assert {r["mood"] for r in spark.read.parquet(cfg.output_dir("label")).collect()} == {"warm"}


def test_all_rows_rejected_or_failed(spark, cfg):
    raw(cfg.raw_dir, "a", [("junk", b"x")])
    assert stats(run_filter(spark, cfg, by_constant("YES"))) == (1, 0, 0, 1)
    assert run_label(spark, cfg, by_constant("{}")) is None
    raw(cfg.raw_dir, "b", numbered(0, 2))
    assert stats(run_filter(spark, cfg, by_constant("no"))) == (2, 0, 2, 0)
    assert run_label(spark, cfg, by_constant("{}")).total == 0


def test_stream_takes_each_file_once(spark, cfg):
    raw(cfg.raw_dir, "a", numbered(0, 3))
    raw(cfg.raw_dir, "b", numbered(3, 5) + [("junk", b"x")])
    calls = spark.sparkContext.accumulator(0)
    assert run_incremental(spark, cfg, model_of("yes", calls), max_files=1) == 2
    assert run_incremental(spark, cfg, model_of("yes", calls), max_files=1) == 0
    raw(cfg.raw_dir, "c", numbered(4, 7))
    assert run_incremental(spark, cfg, model_of("yes", calls), by_constant('{"city":"Rome"}')) == 1
    assert calls.value == 7
    assert ids(spark, cfg) == ids(spark, cfg, "label") == [f"r{i:03d}" for i in range(7)]


def test_stream_repeats_a_batch_without_the_model(spark, cfg, monkeypatch):
    raw(cfg.raw_dir, "a", numbered(0, 4))
    calls = spark.sparkContext.accumulator(0)

    def lost(*args, **kwargs):
        raise OSError("driver lost")

    with monkeypatch.context() as patch:
        patch.setattr(jobs, "write_shards", lost)
        with pytest.raises(Exception):
            run_incremental(spark, cfg, model_of("yes", calls))
    assert calls.value == 4
    assert run_incremental(spark, cfg, model_of("yes", calls)) == 1
    assert calls.value == 4 and len(ids(spark, cfg)) == 4
    assert [r["status"] for r in read_ledger(spark, cfg).orderBy("status").collect()] == ["done", "judged"]


def test_stream_reads_history_once_per_call_and_keeps_keys_in_state(spark, cfg, monkeypatch):
    raw(cfg.raw_dir, "a", numbered(0, 3))
    run_filter(spark, cfg, model_of("yes"))  # a run outside the stream
    raw(cfg.raw_dir, "b", numbered(2, 5))  # r002 was judged by that run
    raw(cfg.raw_dir, "c", numbered(4, 6) + [("r005", png(3, 3))])  # r004 came in b; r005 twice here
    raw(cfg.raw_dir, "d", numbered(6, 8))
    checked = []
    real = jobs.pending_rows
    monkeypatch.setattr(jobs, "pending_rows", lambda *a, **k: checked.append(1) or real(*a, **k))
    calls = spark.sparkContext.accumulator(0)
    assert run_incremental(spark, cfg, model_of("yes", calls), max_files=1) == 4
    assert len(checked) == 1  # the first micro-batch only, however many follow
    assert calls.value == 6  # r003, r004, r005 twice, r006, r007
    assert ids(spark, cfg) == [f"r{i:03d}" for i in range(5)] + ["r005", "r005", "r006", "r007"]
    raw(cfg.raw_dir, "e", numbered(7, 9))
    assert run_incremental(spark, cfg, model_of("yes", calls), max_files=1, profile=None) == 1
    assert len(checked) == 2 and calls.value == 7


def test_new_keys_need_no_call_per_key(spark, path):
    """Keys and files come out once each; all places of a new key in the micro-batch's files are found again."""
    pq.write_table(pa.table({"id": ["a", "b", "a"], "data": [b"1", b"2", b"3"]}), f"{path}/0.parquet")
    pq.write_table(pa.table({"id": ["a", "", None], "data": [b"1", b"2", b"3"]}), f"{path}/1.parquet")
    table = spark.read.parquet(path)
    found = new_keys(table, "id")
    plan = found._jdf.queryExecution().analyzed().toString()
    assert "Deduplicate" in plan and "Pandas" not in plan
    rows = found.collect()
    assert sorted(r["_key"][-9:] for r in rows if r["_is_file"]) == ["0.parquet", "1.parquet"]
    assert len([r for r in rows if not r["_is_file"]]) == 4
    places = places_of(found.where("NOT _is_file AND _key <> 'b'"), with_source(table), "id")
    got = sorted((r["src_file"][-9:], r["src_row"]) for r in places.collect())
    assert got == [("0.parquet", 0), ("0.parquet", 2), ("1.parquet", 0), ("1.parquet", 1), ("1.parquet", 2)]


def test_stream_begun_by_an_earlier_version_judges_nothing_twice(spark, cfg):
    raw(cfg.raw_dir, "a", numbered(0, 2))
    raw(cfg.raw_dir, "b", numbered(2, 4))
    run_filter(spark, cfg, model_of("yes"))  # as that stream did
    os.makedirs(f"{cfg.root}/checkpoints/intake-keyed")
    calls = spark.sparkContext.accumulator(0)
    assert run_incremental(spark, cfg, model_of("yes", calls), max_files=1) == 2
    assert calls.value == 0 and len(ids(spark, cfg)) == 4
