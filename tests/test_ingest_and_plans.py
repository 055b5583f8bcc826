import datetime as dt
import json

from pyspark.sql import functions as F

from meterline.operators.cost import apply_overrides
from meterline.plans.panels import PANELS, PanelParams
from meterline.sources import ingest as IG
from meterline.sources import seeds
from meterline.sources.ingest import flatten_usage_payload, usage_estimate
from meterline.sources.sinks import publish_views
from meterline.sources.star import Star

from conftest import SF_MID


def test_flatten_filters_and_rejects(spark):
    doc = {"accountId": 7, "packages": [
        {"name": "apm_peak", "unitUsages": [
            {"usageType": "APM_APP_AGENT", "data": [
                {"timestamp": "2024-01-02T13:45:00Z", "used": {"avg": 2.5}},
                {"timestamp": "not a time", "used": {"avg": 1.0}},
                {"timestamp": "2024-01-03T00:00:00Z", "used": {"avg": 0}}]},
            {"usageType": "DB_AGENT", "data": [{"timestamp": "2024-01-02T00:00:00Z", "used": {"avg": 9}}]}]},
        {"name": "infra", "unitUsages": [
            {"usageType": "MACHINE_AGENT", "data": [{"timestamp": "2024-01-04T23:59:59Z", "used": {}}]}]}]}
    df = spark.createDataFrame([(json.dumps(doc),)], "payload string")
    good, rej = flatten_usage_payload(df, seeds.capabilities(spark))
    g = good.collect()
    assert [(r.account_id, r.ts, r.capability_code, r.tier, r.units) for r in g] == \
        [(7, dt.datetime(2024, 1, 2), "APM", "Peak", 2.5)]
    reasons = sorted(r.reason for r in rej.collect())
    assert reasons == ["bad_timestamp", "unmapped_usage_type", "zero_usage", "zero_usage"]


def test_usage_estimate_days_inclusive(spark):
    apps = spark.createDataFrame([(1, 2, 3, "Pro")], "app_id long, tier_count int, node_count long, license_tier string")
    e = usage_estimate(apps, dt.date(2024, 1, 10), seeds.capabilities(spark))
    assert e.count() == 2 * 366
    r = e.where((F.col("capability_id") == 1) & (F.col("ts") == F.lit(dt.datetime(2024, 1, 7)).cast("timestamp_ntz"))).collect()[0]
    assert r.units_consumed == round(3 * 1.5 * (0.9 + 0.2 * 0 / 7), 2) and r.nodes_count == 3


def test_overrides_newest_active_unexpired(spark):
    app = spark.createDataFrame([(1, "H1", 2, 1, 1), (2, "H2", 3, 1, 1)],
                                "app_id long, h_code string, sector_id int, owner_id int, architecture_id int")
    ov = spark.createDataFrame([
        (1, "h_code", "OLD", True, None, dt.datetime(2024, 1, 1)),
        (1, "h_code", "NEW", True, None, dt.datetime(2024, 2, 1)),
        (1, "sector", "5", True, dt.datetime(2024, 1, 15), dt.datetime(2024, 1, 1)),   # expired
        (2, "h_code", "OFF", False, None, dt.datetime(2024, 3, 1))],                    # inactive
        "app_id long, field_name string, override_value string, is_active boolean, "
        "expires_at timestamp_ntz, created_at timestamp_ntz")
    out = {r.app_id: (r.h_code, r.sector_id) for r in apply_overrides(app, ov, dt.date(2024, 3, 1)).collect()}
    assert out == {1: ("NEW", 2), 2: ("H2", 3)}


def test_controller_filter_parameter(spark):
    s = Star(spark, SF_MID)
    every = PANELS["d20_total_cost"](s, PanelParams(as_of=s.as_of)).collect()[0][0]
    ctls = [r.controller for r in PANELS["d62_controller_list"](s, PanelParams(as_of=s.as_of)).collect()]
    parts = [PANELS["d20_total_cost"](s, PanelParams(as_of=s.as_of, controller=c)).collect()[0][0] for c in ctls]
    unknown = PANELS["d20_total_cost"](s, PanelParams(as_of=s.as_of, controller="Unknown")).collect()[0][0]
    assert abs(sum(parts) + unknown - every) < 0.01


def test_publish_views_versions_and_failures(spark, tmp_path):
    s = Star(spark, SF_MID)

    def broken():
        raise RuntimeError("boom")

    st = publish_views(spark, {"v1": lambda: s.v1, "broken": broken}, str(tmp_path)).collect()
    by = {r.view: r for r in st}
    assert by["v1"].status == "success" and by["v1"].rows == s.v1.count()
    assert by["broken"].status == "failed" and "boom" in by["broken"].error


def test_controller_list_filter(spark):
    s = Star(spark, SF_MID)
    ctls = sorted(r.controller for r in PANELS["d62_controller_list"](s, PanelParams(as_of=s.as_of)).collect())
    every = {r.time: r.total_cost for r in PANELS["d43_cost_trend_24m"](s, PanelParams(as_of=s.as_of)).collect()}
    listed = {r.time: r.total_cost for r in
              PANELS["d43_cost_trend_24m"](s, PanelParams(as_of=s.as_of, controllers=ctls)).collect()}
    assert listed == every
    one = PANELS["d43_cost_trend_24m"](s, PanelParams(as_of=s.as_of, controllers=ctls[:1])).collect()
    assert sum(r.total_cost for r in one) < sum(every.values())


def test_documents_without_usage_are_rejected_with_their_text(spark):
    bad, empty = '{"accountId": 1, "packages": [', '{"accountId": 2, "packages": [{"name": "x", "unitUsages": []}]}'
    good, rej = flatten_usage_payload(spark.createDataFrame([(bad,), (empty,)], "payload string"), seeds.capabilities(spark))
    assert good.count() == 0
    assert sorted((r.reason, r.payload) for r in rej.collect()) == [("bad_document", bad), ("no_usage", empty)]


def test_unreadable_table_stops_a_merge(spark, tmp_path):
    import pytest
    from meterline.sources import sinks
    path = str(tmp_path / "t")
    spark.createDataFrame([(1, "a", "m1")], "k int, v string, month string").write.partitionBy("month").parquet(path)
    (tmp_path / "t" / "month=m1" / "part-9.parquet").write_bytes(b"PAR1 half a file")
    batch = spark.createDataFrame([(2, "b", "m1")], "k int, v string, month string")
    with pytest.raises(Exception):
        sinks.merge_into_parquet(spark, path, batch, ["k"], "month")
    (tmp_path / "t" / "month=m1" / "part-9.parquet").unlink()
    assert [r.k for r in spark.read.parquet(path).collect()] == [1]


def test_cmdb_fields_are_parsed_only_where_they_can_be_objects(spark):
    texts = ["c-1", ' {"value": "c-2", "link": "x"}', '{"sys_id":"c-3"}', '{"link":"rel"}', "c-{4", "", None, "[1]", '"c-5"']
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = [r["f"] for r in df.select("i", IG.cmdb_field(F.col("t")).alias("f")).orderBy("i").collect()]
    assert got == ["c-1", "c-2", "c-3", '{"link":"rel"}', "c-{4", "", None, "[1]", '"c-5"']
    # a failed parse costs many times a good one: plain text must not reach the parser
    plan = df.select(IG.cmdb_field(F.col("t")).alias("f"))._jdf.queryExecution().optimizedPlan().toString().lower()
    assert "contains(t" in plan


def test_relations_resolve_without_parsing_below_the_join(spark):
    wanted = IG.CMDB_RELATION_TYPE
    rel = spark.createDataFrame(
        [("c-1", '{"value":"s-1"}', wanted), ('{"value":"c-1"}', "s-2", f'{{"value":"{wanted}"}}'), (None, "s-1", wanted),
         ("c-2", None, wanted), ("c-1", "s-3", "Runs on::Hosts"), ("c-1", "s-3", None), ("", "s-1", wanted)],
        "parent string, child string, type string")
    app = spark.createDataFrame([(1, "m", "c-1"), (2, "m", "c-2"), (3, "m", None)], "app_id long, monitoring_id string, cmdb_id string")
    servers = spark.createDataFrame([(f"s-{i}", f"n{i}", "ip", "os", "true") for i in (1, 2, 3)],
                                    "sys_id string, name string, ip_address string, os string, virtual string")
    found = IG.servers_for_matched_apps(rel, servers, app)
    assert sorted(r["sys_id"] for r in found.collect()) == ["s-1", "s-2"]
    assert sorted(map(tuple, IG.app_server_edges(rel, app, found).collect())) == [(1, "s-1", wanted), (1, "s-2", wanted)]
    plan = IG.resolved_relations(rel).join(app.select(F.col("cmdb_id").alias("parent")), "parent")
    lines = plan._jdf.queryExecution().optimizedPlan().toString().splitlines()
    assert not any("Filter" in x and "get_json_object(parent" in x for x in lines)


def test_flat_cmdb_objects_are_cut_as_the_parser_reads_them(spark):
    texts = ['{"value":"c-1","link":"rel"}', '{"sys_id":"s-1"}', '{"value":""}', '{"sys_id":"s-1","value":"v"}', '{"value":"a\\"b"}',
             '{"value":"v","value":"w"}', '{"value":"v","x":{"value":"w"}}', '{"value":null,"sys_id":"s"}', '{"value":"v"', '{"value":"v"} ',
             '{"sys_id":"s","x":"value"}', '{"value":"v","sys_id":"s"}', '{"x":"y","value":"v"}', '{"value":5}', '{"value":"é{ü","a":"b","c":"d"}',
             '{"value":"v",}', "{'value':'v'}", '{"value":"tab\there"}', '{"value":"v"}\n', '{"value" : "v"}', '{"value":"v","":"x"}']
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    parsed = F.coalesce(F.get_json_object("t", "$.value"), F.get_json_object("t", "$.sys_id"), F.col("t"))
    rows = df.select("t", IG.cmdb_field(F.col("t")).alias("f"), parsed.alias("p")).collect()
    assert [(r["t"], r["f"]) for r in rows] == [(r["t"], r["p"]) for r in rows]


def _relation_rows(spark):
    wanted = IG.CMDB_RELATION_TYPE
    rel = spark.createDataFrame([("c-1", "s-1", wanted), ("c-1", '{"value":"s-1"}', wanted), ("c-1", '{"value":""}', wanted),
                                 ("c-2", "s-2", wanted)], "parent string, child string, type string").distinct()
    app = spark.createDataFrame([(1, "m", "c-1"), (2, None, "c-2"), (1, "m", "c-1")], "app_id long, monitoring_id string, cmdb_id string")
    servers = spark.createDataFrame([("s-1", "n", "ip", "os", "true"), ("", "n", "ip", "os", "true"), ("s-2", "", "ip", "os", "true"),
                                     ('{"sys_id":""}', "n", "ip", "os", "true")],
                                    "sys_id string, name string, ip_address string, os string, virtual string")
    return rel, app, IG.servers_for_matched_apps(rel, servers, app.where(F.col("monitoring_id").isNotNull()))


def test_empty_server_ids_are_dropped_without_parsing_relations_below_their_distinct(spark):
    rel, app, found = _relation_rows(spark)
    edges = IG.app_server_edges(rel, app, found)
    assert [r["sys_id"] for r in found.collect()] == ["s-1"]
    assert list(map(tuple, edges.collect())) == [(1, "s-1", IG.CMDB_RELATION_TYPE)]
    lines = edges._jdf.queryExecution().optimizedPlan().toString().splitlines()
    assert not any("Filter" in x and "get_json_object(child" in x for x in lines)


def test_edges_are_joined_and_made_distinct_without_sorting(spark):
    rel, app, found = _relation_rows(spark)
    edges = IG.app_server_edges(rel, app, found)
    assert "Sort" not in edges._jdf.queryExecution().sparkPlan().toString()


def _cmdb_tables(spark, folder):
    """Tables of two matched applications, 1 and 2, and one without a monitoring id, 9; rows repeat and hold nulls."""
    tables = {"region": ("r_regionkey int, r_name string", [(0, "R")]),
              "nation": ("n_nationkey int, n_name string, n_regionkey int", [(0, "N", 0)]),
              "supplier": ("s_suppkey long, s_name string, s_nationkey int", [(k, f"S{k}", 0) for k in (1, 2, 9)]),
              "part": ("p_partkey long, p_name string, p_brand string, p_size int", [(k, f"P{k}", "B", k) for k in (1, 2, 3, 7)]),
              "lineitem": ("l_suppkey long, l_partkey long", [(1, 1), (1, 1), (1, 2), (2, 2), (9, 3), (1, 7), (2, 5), (None, 2), (None, 3),
                                                              (1, None), (None, None)])}
    for name, (schema, rows) in tables.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


def test_relations_are_checked_for_null_ends_by_their_keys(spark, tmp_path):
    from meterline.plans.catalog import queries_extra as QX
    rel = QX.cmdb_relations(spark, _cmdb_tables(spark, tmp_path))
    runs, wanted = "Runs on::Hosts", IG.CMDB_RELATION_TYPE

    def obj(sid):
        return f'{{"value":"{sid}","link":"rel"}}'
    assert sorted(map(tuple, rel.collect()), key=str) == sorted([
        ("c-1", obj("s-1"), wanted), (obj("c-1"), "s-2", wanted), (obj("c-2"), "s-2", wanted), ("c-9", obj("s-3"), wanted),
        ("c-1", obj("s-7"), runs), ("c-2", obj("s-5"), wanted), ('{"link":"rel"}', "s-2", wanted), (None, obj("s-3"), wanted),
        ("c-1", None, wanted), (None, None, wanted)], key=str)
    lines = IG.resolved_relations(rel)._jdf.queryExecution().optimizedPlan().toString().splitlines()
    assert [x for x in lines if "Filter" in x] and not any("Filter" in x and "concat" in x for x in lines)


def test_a_plan_that_counts_servers_and_edges_makes_the_servers_once(spark, tmp_path):
    from meterline.plans.catalog import queries_reports as QR
    folder = _cmdb_tables(spark, tmp_path)
    servers = QR._servers(spark, folder)
    edges = QR._edges(spark, folder, Star(spark, folder).app, servers)
    assert sorted(r["sys_id"] for r in servers.collect()) == ["s-1", "s-2"]
    assert sorted((r["app_id"], r["server_sys_id"]) for r in edges.collect()) == [(2, "s-1"), (2, "s-2"), (3, "s-2")]
    both = servers.agg(F.count(F.lit(1)).alias("n")).unionByName(edges.agg(F.count(F.lit(1)).alias("n")))
    assert sorted(r["n"] for r in both.collect()) == [2, 3]
    final = both._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0].splitlines()
    shared = [x for x in final if "REBALANCE_PARTITIONS_BY_COL" in x]
    assert len(shared) == 2 and sum("ReusedExchange" in x for x in shared) == 1


def test_chargeback_adds_no_null_check_to_the_facts(spark):
    from meterline.operators.chargeback import direct_chargeback
    cost = spark.sql("select timestamp_ntz'2001-01-05 00:00:00' as ts, app_id, cast(usd as decimal(12,2)) as usd_cost "
                     "from values (1L, 2), (1L, 3), (cast(null as bigint), 5), (9L, 7) as t(app_id, usd)")
    cost = spark.createDataFrame(cost.collect(), cost.schema)
    app = spark.createDataFrame([(1, "H", None, 2), (None, "N", 1, 1)], "app_id long, h_code string, sector_id int, owner_id int")
    charged = direct_chargeback(cost, app)
    assert [(r["app_id"], r["h_code"], r["sector_id"], r["owner_id"], int(r["usd_amount"])) for r in charged.collect()] == [(1, "H", 1, 2, 5)]
    # of the two frames only the applications are checked, so that the facts are shuffled as for other readers of the cost
    assert charged._jdf.queryExecution().optimizedPlan().toString().count("isnotnull(app_id") == 1
