import datetime as dt
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from meterline.sources import sinks as SK
from meterline.sources.runlog import RunLog

SCHEMA = "month_start date, app_id long, sector_id int, usd_amount double, cycle string"
K = ["month_start", "app_id", "sector_id"]
M = dt.date(2024, 1, 1)


def test_upserts_and_tally(spark):
    t = spark.createDataFrame([(M, 1, 1, 10.0, "direct"), (M, 2, None, 5.0, "direct")], SCHEMA)
    b = spark.createDataFrame([(M, 1, 1, 3.0, "direct"), (M, 3, 1, 1.0, "x"), (M, 2, None, 7.0, "direct")], SCHEMA)
    rep = sorted(tuple(r) for r in SK.upsert_replace(t, b, K).collect())
    assert (M, 1, 1, 3.0, "direct") in rep and len(rep) == 4          # null key part never conflicts
    add = {(r.app_id, r.sector_id): r.usd_amount for r in SK.upsert_add(t, b, K, ["usd_amount"]).collect()}
    assert add[(1, 1)] == 13.0
    ins = SK.insert_if_absent(t, b, K).collect()
    assert len(ins) == 4 and sorted(r.usd_amount for r in ins if r.app_id == 1) == [10.0]
    tally = SK.upsert_tally(t, b, K).collect()[0]
    assert (tally.inserted, tally.updated) == (2, 1)


def test_replace_is_idempotent(spark):
    t = spark.createDataFrame([(M, 1, 1, 10.0, "direct")], SCHEMA)
    b = spark.createDataFrame([(M, 1, 1, 4.0, "direct"), (M, 2, 1, 1.0, "direct")], SCHEMA)
    once = SK.upsert_replace(t, b, K)
    twice = SK.upsert_replace(once, b, K)
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, twice.collect()))


def test_merge_into_parquet_touches_only_batch_partitions(spark, tmp_path):
    path = str(tmp_path / "cb")
    t = spark.createDataFrame([(M, 1, 1, 10.0, "direct"), (dt.date(2024, 2, 1), 1, 1, 20.0, "direct")], SCHEMA)
    SK.write_table(t, path, ["month_start"])
    b = spark.createDataFrame([(dt.date(2024, 2, 1), 1, 1, 2.0, "direct")], SCHEMA)
    SK.merge_into_parquet(spark, path, b, K, "month_start", how="add", measures=["usd_amount"])
    got = {r.month_start: r.usd_amount for r in spark.read.parquet(path).collect()}
    assert got == {M: 10.0, dt.date(2024, 2, 1): 22.0}


FEB = dt.date(2024, 2, 1)


def _stages(spark):
    folder = Path(SK.scratch_path(spark, "stage")).parent
    return sorted(p.name for p in folder.glob("stage-*"))


def test_replaced_slices_leave_no_stale_row_and_no_stage(spark, tmp_path):
    path = str(tmp_path / "cb")
    old = [(M, 1, 1, 10.0, "direct"), (M, 1, 2, 4.0, "alloc_a"), (M, 1, 3, 6.0, "alloc_b"), (FEB, 1, 2, 1.0, "alloc_a"),
           (dt.date(2024, 3, 1), 1, 2, 9.0, "alloc_a")]
    SK.write_table(spark.createDataFrame(old, SCHEMA), path, ["month_start"])
    stages = _stages(spark)
    # January: the app moved from one method to the other; February: nothing is posted any more
    new = spark.createDataFrame([(M, 1, 2, 5.0, "alloc_b")], SCHEMA)
    SK.replace_slices(spark, path, new, "month_start", [M, FEB], "cycle", ["alloc_a", "alloc_b"], cluster_by=["app_id"])
    got = sorted((r.month_start, r.sector_id, r.usd_amount, r.cycle) for r in spark.read.parquet(path).collect())
    assert got == [(M, 1, 10.0, "direct"), (M, 2, 5.0, "alloc_b"), (dt.date(2024, 3, 1), 2, 9.0, "alloc_a")]
    assert _stages(spark) == stages


def test_a_read_error_leaves_the_table_as_it_is(spark, tmp_path):
    path = tmp_path / "cb"
    SK.write_table(spark.createDataFrame([(M, 1, 1, 10.0, "direct"), (M, 2, 1, 2.0, "direct")], SCHEMA), str(path), ["month_start"])
    bad = path / f"month_start={M}" / "part-broken.parquet"
    bad.write_bytes(b"PAR1 cut off")
    names = sorted(p.name for p in path.rglob("*.parquet"))
    batch = spark.createDataFrame([(M, 3, 1, 1.0, "x")], SCHEMA)
    with pytest.raises(Exception):
        SK.merge_into_parquet(spark, str(path), batch, K, "month_start")
    with pytest.raises(Exception):
        SK.replace_slices(spark, str(path), batch, "month_start", [M], "cycle", ["x"])
    assert sorted(p.name for p in path.rglob("*.parquet")) == names


def test_published_views_have_a_current_version(spark, tmp_path):
    root = str(tmp_path / "views")
    assert SK.published(spark, root) == {}
    first = SK.publish_views(spark, {"a": lambda: spark.range(3), "b": lambda: spark.range(2)}, root).collect()
    assert [(r.view, r.status, r.rows_before, r.rows) for r in first] == [("a", "success", 0, 3), ("b", "success", 0, 2)]
    second = SK.publish_views(spark, {"a": lambda: spark.range(5), "b": lambda: spark.range(1).select(F.col("none"))}, root).collect()
    assert [(r.view, r.status, r.rows_before, r.rows) for r in second] == [("a", "success", 3, 5), ("b", "failed", 2, None)]
    assert {n: df.count() for n, df in SK.published(spark, root).items()} == {"a": 5, "b": 2}      # the failed one keeps its last


def test_run_log(spark, tmp_path):
    log = RunLog(spark, str(tmp_path / "log"))
    assert log.state().count() == 0 and log.last_success("load") is None and not log.is_active("load")
    a = log.start("load", {"source": "x", "try": "1"})
    assert log.is_active("load")
    log.end(a, "success", rows=7, metadata={"try": "2"})
    b = log.start("load")
    log.end(b, "failed", error="no disk")
    with pytest.raises(ValueError):
        log.end(b, "done")
    got = {r.run_id: r for r in log.state().collect()}
    assert got[a].status == "success" and got[a].rows_ingested == 7 and got[a].metadata == {"source": "x", "try": "2"}
    assert got[b].error_message == "no disk" and not log.is_active("load")
    assert log.last_success("load") == got[a].finished_at
