"""Versioned tables, incremental loads, refreshes and the run log's leases."""

import datetime as dt
import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from meterline.operators import reconcile as R
from meterline.operators.inventory import gapless_ids, upsert_inventory
from meterline.plans import quality as Q
from meterline.plans import refresh as RF
from meterline.plans.pipeline import _with_month
from meterline.sources import sinks as SK
from meterline.sources import versions as VS
from meterline.sources.runlog import JobActive, RunLog
from meterline.sources.star import Star

from conftest import SF_SMALL

JAN, FEB, MAR = (dt.date(2024, m, 1) for m in (1, 2, 3))
SCHEMA = "month date, app_id long, amount decimal(12,2), note string"


def frame(spark, rows):
    return spark.createDataFrame([(m, a, x if x is None else __import__("decimal").Decimal(x), n) for m, a, x, n in rows], SCHEMA)


def rows_of(df):
    return sorted(((r.month, r.app_id, None if r.amount is None else float(r.amount), r.note) for r in df.collect()), key=repr)


@pytest.fixture
def table(spark, tmp_path):
    t = VS.Table(spark, str(tmp_path / "t"), "month", ["app_id"])
    t.append(frame(spark, [(JAN, 1, 1, "a"), (FEB, 1, 2, "b"), (None, 9, 3, None)]))
    return t


def test_append_replace_and_rewrite(spark, table):
    assert rows_of(table.read()) == rows_of(frame(spark, [(JAN, 1, 1, "a"), (FEB, 1, 2, "b"), (None, 9, 3, None)]))
    before = table.stamps()
    assert table.append(frame(spark, [(FEB, 2, 5, "c")])) == {str(FEB)}
    assert table.rewrite([FEB], lambda old: old.withColumn("amount", (F.col("amount") * 2).cast("decimal(12,2)"))) == {str(FEB)}
    assert rows_of(table.read([FEB])) == [(FEB, 1, 4.0, "b"), (FEB, 2, 10.0, "c")]
    now = table.stamps()
    assert {p for p in now if now[p] != before.get(p)} == {str(FEB)}                  # no other file was touched
    table.replace(frame(spark, []), [JAN, FEB])
    assert rows_of(table.read()) == [(None, 9, 3.0, None)] and table.read([JAN]).count() == 0
    with pytest.raises(ValueError):
        table.replace(frame(spark, [(MAR, 1, 1, "x")]), [JAN])
    assert rows_of(table.read()) == [(None, 9, 3.0, None)]
    assert rows_of(table.read(version=1)) == rows_of(frame(spark, [(JAN, 1, 1, "a"), (FEB, 1, 2, "b"), (None, 9, 3, None)]))


def test_an_empty_first_write_can_be_read(spark, tmp_path):
    t = VS.Table(spark, str(tmp_path / "none"), "month")
    assert not t.exists()
    t.append(frame(spark, []))
    assert t.exists() and t.read().columns == ["month", "app_id", "amount", "note"] and t.read().count() == 0
    t.merge(frame(spark, [(JAN, 1, 1, "a")]), lambda old, new: SK.upsert_replace(old, new, ["month", "app_id"]))
    assert rows_of(t.read()) == [(JAN, 1, 1.0, "a")]


@pytest.mark.parametrize("step", ["write_table", "names_in", "create_exclusive"])
@pytest.mark.parametrize("when", ["before", "after"])
def test_a_failure_at_any_step_leaves_the_old_or_the_new_table(spark, table, monkeypatch, step, when):
    old = rows_of(table.read())
    new = rows_of(frame(spark, [(JAN, 7, 7, "new"), (FEB, 1, 2, "b"), (None, 9, 3, None)]))
    real = getattr(VS, step)

    def broken(*a, **b):
        if when == "after" and not (step == "names_in" and VS.MANIFESTS in a[1]):
            real(*a, **b)
        raise OSError("forced")

    batch = frame(spark, [(JAN, 7, 7, "new")])
    with monkeypatch.context() as m:
        m.setattr(VS, step, broken)
        with pytest.raises(OSError):
            table.replace(batch, [JAN])
    assert rows_of(table.read()) == (new if (step, when) == ("create_exclusive", "after") else old)
    table.replace(batch, [JAN])
    assert rows_of(table.read()) == new
    named = {f.split("/")[0] for fs in table.stamps().values() for f in fs}
    table.vacuum(keep=1, older_than_hours=0)
    assert {p.name for p in Path(table.path).glob("c=*")} == named and rows_of(table.read()) == new


def test_two_writers(spark, table):
    base = table.manifest()
    table.rewrite([JAN], lambda old: old.withColumn("note", F.lit("first")))
    with pytest.raises(VS.ConcurrentChange):
        table.replace(frame(spark, [(JAN, 1, 1, "second")]), [JAN], base=base)
    table.replace(frame(spark, [(FEB, 1, 1, "second")]), [FEB], base=base)             # other partitions: both stand
    assert rows_of(table.read([JAN, FEB])) == [(FEB, 1, 1.0, "second"), (JAN, 1, 1.0, "first")] or \
        {r[3] for r in rows_of(table.read([JAN, FEB]))} == {"first", "second"}
    path = f"{table.path}/one"
    assert VS.create_exclusive(spark, path, "a") and not VS.create_exclusive(spark, path, "b")
    assert VS.read_text(spark, path) == "a" and not list(Path(table.path).glob("*.tmp"))


def test_a_load_reads_new_files_and_touched_months_only(spark, tmp_path):
    feed, seen = tmp_path / "feed", []
    feed.mkdir()
    t = VS.Table(spark, str(tmp_path / "usage"), "month")

    def parse(paths):
        seen.append(sorted(p.rsplit("/", 1)[1] for p in paths))
        return spark.read.schema(SCHEMA).json(paths)

    def put(name, *rows):
        (feed / name).write_text("\n".join(json.dumps({"month": str(m), "app_id": a, "amount": x, "note": n}) for m, a, x, n in rows))

    keys = ["month", "app_id"]
    assert VS.load_new_files(t, str(feed), parse, keys) == (0, set()) and not t.exists()
    put("a.json", (JAN, 1, 1, "a"), (JAN, None, 2, "a"))
    assert VS.load_new_files(t, str(feed), parse, keys) == (1, {str(JAN)})
    jan = t.stamps()[str(JAN)]
    put("b.json", (FEB, 1, 5, "b"))
    put("c.json", (FEB, 1, 6, "again"), (FEB, 2, 7, "c"))
    assert VS.load_new_files(t, str(feed), parse, keys)[0] == 2
    assert VS.load_new_files(t, str(feed), parse, keys) == (0, set())
    put("d.json", (JAN, 1, 9, "late"), (JAN, None, 9, "late"), (JAN, 3, 3, "late"))
    VS.load_new_files(t, str(feed), parse, keys)
    assert seen == [["a.json"], ["b.json", "c.json"], ["d.json"]] and t.stamps()[str(JAN)][:1] == jan
    assert [r[1:] for r in rows_of(t.read([JAN]))] == [(1, 1.0, "a"), (3, 3.0, "late"), (None, 2.0, "a")]
    assert len(rows_of(t.read([FEB]))) == 2


def test_merges_on_stored_facts_keep_sums_and_keys(spark, tmp_path):
    t = VS.Table(spark, str(tmp_path / "fact"), "month")
    facts = [(JAN, 1, "1.10", "own"), (JAN, 9, "2.20", "moved"), (JAN, 3, "4", "other"), (FEB, 1, "8", "own"), (MAR, 9, "16", "moved"),
             (MAR, 9, "0.5", "moved")]
    t.append(frame(spark, facts))
    before = t.stamps()
    ids = spark.createDataFrame([(9, 1), (77, 3)], "old_app_id long, new_app_id long")
    assert R.repoint_table(t, ids, ["month", "app_id"], ["amount"]) == [JAN, MAR]
    assert rows_of(t.read()) == [(FEB, 1, 8.0, "own"), (JAN, 1, 3.3, "own"), (JAN, 3, 4.0, "other"), (MAR, 1, 16.5, "moved")] or \
        {r[:3] for r in rows_of(t.read())} == {(JAN, 1, 3.3), (JAN, 3, 4.0), (FEB, 1, 8.0), (MAR, 1, 16.5)}
    assert [r[3] for r in rows_of(t.read()) if r[:2] == (JAN, 1)] == ["own"]
    assert t.stamps()[str(FEB)] == before[str(FEB)]
    version = t.versions()
    assert R.repoint_table(t, ids, ["month", "app_id"], ["amount"]) == [] and t.versions() == version


DIM = "app_id long, monitoring_id string, controller string, app_name string, owner_id int, sector_id int, cmdb_id string"


def test_inventory_upsert_keeps_owners_and_gives_gapless_ids(spark):
    dim = spark.createDataFrame([(4, "a", "c1", "old", 7, None, "x"), (5, None, None, None, 2, 2, "y"), (6, "a", "c2", "two", 3, 3, None)], DIM)
    feed = spark.createDataFrame([("a", "c1", "new", 1, 1)] + [(f"n{i}", "c1", f"app {i}", 1, 1) for i in range(50)] + [(None, "c1", "no id", 1, 1)],
                                 "monitoring_id string, controller string, app_name string, owner_id int, sector_id int")
    got = sorted(map(tuple, upsert_inventory(dim, feed).collect()))
    assert got[:3] == [(4, "a", "c1", "new", 7, None, "x"), (5, None, None, None, 2, 2, "y"), (6, "a", "c2", "two", 3, 3, None)]
    assert [r[0] for r in got] == list(range(4, 57))
    assert [r[1] for r in got[3:]] == sorted(f"n{i}" for i in range(50)) and {r[4:] for r in got[3:]} == {(1, 1, None)}
    assert upsert_inventory(dim, feed.limit(0)).count() == 3 and upsert_inventory(dim.limit(0), feed).agg(F.max("app_id")).first()[0] == 51
    assert gapless_ids(feed.limit(0), ["monitoring_id"], 1, "id").count() == 0


def test_enrichment_logs_changes_only(spark):
    app = spark.createDataFrame([(1, "m1", "Pay", None, None, None), (2, "m2", "hr", "c-old", "x", "g"), (3, None, None, "c9", "z", None),
                                 (4, "m4", "none", None, None, None)],
                                "app_id long, monitoring_id string, app_name string, cmdb_id string, cmdb_name string, support_group string")
    cmdb = spark.createDataFrame([("s1", "PAY", "ops"), ("s2", "Hr", "people"), ("s3", None, "x")], "sys_id string, name string, support_group string")
    one, log, rate = R.enrich(app, cmdb)
    assert sorted((r.app_id, r.cmdb_id, r.cmdb_name, r.support_group) for r in one.collect()) == [
        (1, "s1", "PAY", "ops"), (2, "s2", "Hr", "people"), (3, "c9", "z", None), (4, None, None, None)]
    assert tuple(rate.first()) == (3, 2, 66.666667) and log.count() == 2
    log = log.withColumn("logged_at", F.lit(1))
    assert R.enrich(one, cmdb, log)[1].count() == 0
    changed = cmdb.withColumn("support_group", F.when(F.col("sys_id") == "s2", F.lit("new")).otherwise(F.col("support_group")))
    more = R.enrich(one, changed, log)[1]
    assert [r.resolved_app_id for r in more.collect()] == [2]
    log = log.unionByName(more.withColumn("logged_at", F.lit(2)))
    assert R.enrich(one, changed, log)[1].count() == 0 and R.enrich(one, cmdb, log)[1].count() == 1      # back again: a change


def test_a_lease_has_one_holder(spark, tmp_path):
    a, b = (RunLog(spark, str(tmp_path / "log")) for _ in range(2))
    n = a.acquire("load")
    with pytest.raises(JobActive):
        b.acquire("load")
    assert b.is_active("load") and b.acquire("other") == 1
    a.release("load", n)
    assert not b.is_active("load")
    m = b.acquire("load", hours=-1)                          # run out at once: its holder is gone
    assert m == n + 1 and a.acquire("load") == m + 1
    # two that saw the same state: the second creation fails
    stale = a._lease
    c = RunLog(spark, str(tmp_path / "log"))
    a.release("load", m + 1)
    c._lease = lambda job: (m + 1, False)
    assert a.acquire("load") == m + 2 and stale("load") == (m + 2, True)
    with pytest.raises(JobActive):
        c.acquire("load")


def test_the_run_log_is_folded(spark, tmp_path, monkeypatch):
    log = RunLog(spark, str(tmp_path / "log"), most_files=6)
    open_run = log.start("slow", {"k": "1"})
    for i in range(8):
        log.end(log.start("load", {"i": str(i)}), "success", rows=i, metadata={"done": "yes"})
    assert len(log._files()) <= 6
    state = {(r.job_name, r.rows_ingested): r for r in log.state().collect()}
    assert len(state) == 9 and state["load", 3].metadata == {"i": "3", "done": "yes"} and state["slow", None].status == "running"
    log.end(open_run, "failed", error="late", metadata={"k": "2"})
    before = sorted(map(str, log.state().collect()))
    with monkeypatch.context() as m:                        # the fold is committed, its files are not removed yet
        m.setattr(RunLog, "_delete", lambda self, names: None)
        log.compact()
    assert sorted(map(str, log.state().collect())) == before and log._files()
    log.start("more")
    log.compact()
    assert not log._files() and log.state().count() == 10
    assert [r.job_name for r in log.latest(runs=3).collect()][0] == "more" and log.latest(runs=3).count() == 3


def test_refresh_equals_a_rebuild_and_reads_changed_months_only(spark, tmp_path):
    base = Star(spark, SF_SMALL)
    facts = RF.Facts(base, str(tmp_path / "wh"))
    usage, cost = _with_month(base.usage).cache(), _with_month(base.cost).cache()
    months = sorted({r[0] for r in cost.select("month").distinct().collect()})
    late = months[-2]
    for name, fact in (("usage", usage), ("cost", cost)):
        facts.tables[name].append(fact.where(F.col("month") != F.lit(late)))
    facts.tables["chargeback"].append(base.chargeback.where(F.col("month_start") != F.lit(late)))
    first = {r.view: r for r in RF.refresh_views(facts).collect()}
    assert {r.mode for r in first.values()} == {"full"} and {r.status for r in first.values()} == {"success"}
    kept = RF.StoredChecks(facts)
    assert len(kept.refresh()) == len(months) - 1
    for name, fact in (("usage", usage), ("cost", cost)):
        facts.tables[name].append(fact.where(F.col("month") == F.lit(late)))
    facts.tables["chargeback"].append(base.chargeback.where(F.col("month_start") == F.lit(late)))
    read, real = [], VS.Table.read

    def watched(self, parts=None, version=None):
        if self.path.endswith("_fact"):
            read.append(parts and sorted(parts))
        return real(self, parts, version)

    VS.Table.read = watched
    try:
        again = {r.view: r for r in RF.refresh_views(facts, ["v1", "v6", "v7", "v8"]).collect()}
        assert kept.refresh() == [late] and kept.refresh() == []
    finally:
        VS.Table.read = real
    assert {r.mode for r in again.values()} == {"incremental"} and {r.months for r in again.values()} == {1}
    assert {tuple(p) for p in read} == {(late,)}
    views = RF.published(spark, facts.root)
    for v in ("v1", "v6", "v7", "v8"):
        assert sorted(map(str, views[v].collect())) == sorted(map(str, getattr(base, v).collect())), v
    assert {r.mode for r in RF.refresh_views(facts, ["v1", "v6"]).collect()} == {"unchanged"}
    assert tuple(kept.orphan_usage().first()) == tuple(Q.orphan_usage(base.usage, base.cost, base.as_of).first())
    assert tuple(kept.cost_variance().first()) == tuple(Q.cost_variance(base.usage, base.cost, base.price, base.as_of).first())
    full = {r.check_name: r.violations for r in Q.constraint_checks({"usage": base.usage, "cost": base.cost, "app": base.app}).collect()}
    got = {r.check_name: r.violations for r in kept.violations().collect()}
    assert {k: got.get(k, 0) for k in full if k in got or full[k]} == {k: v for k, v in full.items() if k in got or v}


def test_a_failed_swap_keeps_the_stage(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "cb")
    SK.write_table(frame(spark, [(JAN, 1, 1, "a")]), path, ["month"])
    kept, real = [], SK.write_table

    def broken(rows, where, *a, **b):
        if where == path:
            raise OSError("forced")
        kept.append(where)
        return real(rows, where, *a, **b)

    monkeypatch.setattr(SK, "write_table", broken)
    with pytest.raises(OSError):
        SK.merge_into_parquet(spark, path, frame(spark, [(JAN, 2, 2, "b")]), ["month", "app_id"], "month")
    assert spark.read.parquet(path).count() == 1 and spark.read.parquet(kept[0]).count() == 2
    monkeypatch.undo()
    none = str(tmp_path / "none")
    SK.merge_into_parquet(spark, none, frame(spark, []), ["month", "app_id"], "month")
    SK.merge_into_parquet(spark, none, frame(spark, [(JAN, 2, 2, "b")]), ["month", "app_id"], "month")
    assert spark.read.parquet(none).count() == 1


def test_prices_by_day_equal_the_range_join(spark):
    from meterline.operators import cost as CO
    from meterline.session import config_table
    schema = "price_id int, capability_id int, tier string, unit_rate decimal(10,4), start_date date, end_date date"
    d = dt.date
    rows = [(1, 1, "Peak", __import__("decimal").Decimal("0.5"), d(2024, 1, 5), d(2024, 3, 1)), (2, 1, "Peak", __import__("decimal").Decimal("0.7"), d(2024, 3, 2), None),
            (3, 1, "Pro", __import__("decimal").Decimal("0.2"), d(2024, 2, 10), d(2024, 2, 10)), (4, 2, "Peak", __import__("decimal").Decimal("1"), d(2030, 1, 1), None),
            (5, 2, "Pro", __import__("decimal").Decimal("1"), d(2024, 5, 1), d(2024, 4, 1))]
    days = [d(2024, 1, 4), d(2024, 1, 5), d(2024, 2, 10), d(2024, 2, 29), d(2024, 3, 1), d(2024, 3, 2), d(2024, 7, 9)]
    usage = spark.createDataFrame([(dt.datetime.combine(x, dt.time(13)), 1, c, t, 2.0) for x in days for c in (1, 2, 3) for t in ("Peak", "Pro", None)]
                                  + [(None, 1, 1, "Peak", 1.0)],
                                  "ts timestamp_ntz, app_id long, capability_id int, tier string, units_consumed double")
    for how in ("inner", "left"):
        small = CO.price_window_join(usage, config_table(spark, rows, schema), how)
        large = CO.price_window_join(usage, spark.createDataFrame(rows, schema), how)

        def keys(df):
            return sorted(((str(r.ts), r.capability_id, r.tier, r.price_id) for r in df.collect()), key=repr)
        assert keys(small) == keys(large) and len(keys(large)) >= 7
    assert CO.price_window_join(usage, spark.createDataFrame(rows, schema).limit(0)).count() == 0


def test_merged_sketches_count_different_applications(spark):
    from meterline.operators import views as V
    cost = spark.createDataFrame([(dt.datetime(2024, 1, 1 + i % 23), i % 700, "Peak", 1.0) for i in range(3000)],
                                 "ts timestamp_ntz, app_id long, tier string, usd_cost double")
    app = spark.createDataFrame([(i, f"c{i % 3}") for i in range(700)], "app_id long, controller string")
    view = V.v1_daily_cost_by_controller(cost, app, dt.date(2024, 2, 1), sketches=True)
    got = V.apps_of(view).first().apps
    assert abs(got - 700) <= 3 * V.SKETCH_ERROR * 700 and view.agg(F.sum("app_count")).first()[0] > 700
    by = {r.controller: r.apps for r in V.apps_of(view, "controller").collect()}
    assert all(abs(n - 233) <= 10 for n in by.values())
