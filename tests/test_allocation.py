import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from meterline.operators import views as V
from meterline.operators.allocation import allocate_shared_costs, allocation_residuals, select_rules, shared_services
from meterline.sources import seeds

APP = "app_id long, app_name string, cmdb_name string, h_code string, sector_id int"
M = dt.datetime(2024, 1, 5)


def _frames(spark, apps, costs, usage):
    app = spark.createDataFrame(apps, APP)
    cost = spark.createDataFrame([(M, a, 1, "Pro", Decimal(c)) for a, c in costs],
                                 "ts timestamp_ntz, app_id long, capability_id int, tier string, usd_cost decimal(12,2)")
    use = spark.createDataFrame([(M, a, 1, "Pro", Decimal(u)) for a, u in usage],
                                "ts timestamp_ntz, app_id long, capability_id int, tier string, units_consumed decimal(12,2)")
    return app, cost, use


def test_equal_split_three_sectors_residual_cent(spark):
    apps = [(1, "g", None, "H-GLOBAL_IT", 2), (2, "a", None, "X", 3), (3, "b", None, "X", 4), (4, "c", None, "X", 5)]
    app, cost, use = _frames(spark, apps, [(1, "10.00")], [(2, "1")])
    out = allocate_shared_costs(cost, use, app, seeds.sectors(spark), seeds.allocation_rules(spark))
    rows = sorted((r.sector_id, r.usd_amount, r.chargeback_cycle) for r in out.collect())
    assert rows == [(3, Decimal("3.33"), "allocated_equal_split"), (4, Decimal("3.33"), "allocated_equal_split"),
                    (5, Decimal("3.33"), "allocated_equal_split")]
    res = allocation_residuals(cost, out).collect()[0]
    assert abs(res.residual - 0.01) < 1e-9


def test_proportional_half_even_and_skips(spark):
    apps = [(1, "p", None, "H-PLATFORM", 2), (2, "a", None, "X", 3), (3, "b", None, "X", 4),
            (5, "zero", None, "H-PLATFORM", 6), (6, "nosector", None, "H-PLATFORM", None)]
    # app 1: cost 0.05 split 1:1 -> 0.025 each -> half-even 0.02
    app, cost, use = _frames(spark, apps, [(1, "0.05"), (5, "0.00"), (6, "5.00")], [(2, "1"), (3, "1")])
    out = allocate_shared_costs(cost, use, app, seeds.sectors(spark), seeds.allocation_rules(spark))
    rows = sorted((r.app_id, r.sector_id, r.usd_amount) for r in out.collect())
    # zero-cost app 5 skipped; app 6 has no sector -> not a shared service
    assert rows == [(1, 3, Decimal("0.02")), (1, 4, Decimal("0.02"))]


def test_custom_formula_and_rule_order(spark):
    apps = [(1, "s", None, "H-SHARED_SVC-PLATFORM", 2), (2, "a", None, "X", 3), (3, "b", None, "X", 4)]
    app, cost, use = _frames(spark, apps, [(1, "100.00")], [(2, "3"), (3, "1")])
    # first matching rule by id: PLATFORM (rule 1) wins over SHARED_SVC (rule 3)
    sel = select_rules(shared_services(app, seeds.sectors(spark)), seeds.allocation_rules(spark)).collect()
    assert sel[0].distribution_method == "proportional_usage"
    apps[0] = (1, "s", None, "H-SHARED_SVC", 2)
    app, cost, use = _frames(spark, apps, [(1, "100.00")], [(2, "3"), (3, "1")])
    out = allocate_shared_costs(cost, use, app, seeds.sectors(spark), seeds.allocation_rules(spark))
    rows = sorted((r.sector_id, r.usd_amount) for r in out.collect())
    # 40 * 3/4 + 60/2 = 60 ; 40 * 1/4 + 30 = 40
    assert rows == [(3, Decimal("60.00")), (4, Decimal("40.00"))]


def test_case_sensitive_rule_match(spark):
    apps = [(1, "s", None, "h-platform", 2), (2, "a", None, "X", 3)]
    app, cost, use = _frames(spark, apps, [(1, "1.00")], [(2, "1")])
    assert shared_services(app, seeds.sectors(spark)).count() == 1          # ILIKE identifies it
    assert select_rules(shared_services(app, seeds.sectors(spark)), seeds.allocation_rules(spark)).count() == 0


def test_monthly_ranks_cross_value_bands(spark):
    """Ranks of one controller's month over amounts of several magnitudes, with ties."""
    amounts = [0.01, 0.01, 0.02, 5.0, 5.0, 5.01, 5.02, 80.0, 79.99, 1_000_000.0, 0.0, -3.0, -3.01]
    cost = spark.createDataFrame([(dt.datetime(2001, 10, 2), i, "Peak", Decimal(str(a))) for i, a in enumerate(amounts)],
                                 "ts timestamp_ntz, app_id long, tier string, usd_cost decimal(12,2)")
    app = spark.createDataFrame([(i, f"a{i}", f"m-{i}", None, 1, 1, "Peak") for i in range(len(amounts))],
                                "app_id long, app_name string, monitoring_id string, controller string, sector_id int, "
                                "owner_id int, license_tier string")
    got = {r.app_id: r.cost_rank for r in V.v6_app_cost_rankings_monthly(
        cost, app, seeds.sectors(spark), seeds.owners(spark), dt.date(2001, 11, 5)).collect()}
    assert got == {i: 1 + sum(b > a for b in amounts) for i, a in enumerate(amounts)}
