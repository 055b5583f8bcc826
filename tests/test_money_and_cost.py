import datetime as dt
from decimal import Decimal
from fractions import Fraction

from pyspark.sql import functions as F

from meterline.functions.money import round_half_even_ratio, round_half_up_ratio
from meterline.operators.cost import calculate_costs, price_overlaps, price_as_of
from meterline.sources import seeds


def _he(n, d):
    f = Fraction(n, d)
    q = f.numerator // f.denominator
    r = f - q
    return q + 1 if r > Fraction(1, 2) or (r == Fraction(1, 2) and q % 2) else q


def test_half_even_and_half_up(spark):
    rows = [(5, 2), (7, 2), (-5, 2), (-7, 2), (1, 3), (2, 3), (10**20 + 1, 2), (0, 5)]
    df = spark.createDataFrame([(str(a), str(b)) for a, b in rows], "n string, d string")
    df = df.select(F.col("n").cast("decimal(38,0)").alias("n"), F.col("d").cast("decimal(38,0)").alias("d"))
    got = df.select(round_half_even_ratio(F.col("n"), F.col("d")).alias("e"),
                    round_half_up_ratio(F.col("n"), F.col("d")).alias("u")).collect()
    for (n, d), r in zip(rows, got):
        assert int(r.e) == _he(n, d)
        exp_up = int((Decimal(abs(n)) / Decimal(d)).quantize(Decimal(1), rounding="ROUND_HALF_UP")) * (1 if n >= 0 else -1)
        assert int(r.u) == exp_up


def test_price_windows_inclusive_open_and_gap(spark):
    prices = seeds.prices(spark, rows=[(1, 1, "Peak", "1.0000", "2024-01-01", "2024-01-10"),
                                       (2, 1, "Peak", "2.0000", "2024-01-12", None)])
    usage = spark.createDataFrame(
        [(dt.datetime(2024, 1, d), 1, 1, "Peak", Decimal("1.005")) for d in (1, 10, 11, 12, 30)] +
        [(dt.datetime(2024, 1, 5), 1, 1, None, Decimal("1.00"))],
        "ts timestamp_ntz, app_id long, capability_id int, tier string, units_consumed decimal(12,3)")
    out = {r.ts.day: (r.price_id, r.usd_cost) for r in calculate_costs(usage, prices).collect()}
    assert out == {1: (1, Decimal("1.01")), 10: (1, Decimal("1.01")), 12: (2, Decimal("2.01")),
                   30: (2, Decimal("2.01"))}
    assert price_overlaps(prices).count() == 0


def test_overlapping_prices_detected_and_rate_as_of(spark):
    prices = seeds.prices(spark, rows=[(1, 1, "Pro", "1.0000", "2024-01-01", None),
                                       (2, 1, "Pro", "3.0000", "2024-02-01", None)])
    assert price_overlaps(prices).count() == 1
    r = price_as_of(prices, dt.date(2024, 3, 1)).collect()
    assert r[0].unit_rate == Decimal("3.0000")


def test_seed_prices_do_not_overlap(spark):
    assert price_overlaps(seeds.prices(spark)).count() == 0


def test_only_small_literal_tables_are_broadcast_by_hint(spark):
    from meterline.session import CONFIG_MAX_ROWS, bounded_broadcast, config_table
    small = config_table(spark, [(1,), (2,)], "id long")
    big = config_table(spark, [(i,) for i in range(CONFIG_MAX_ROWS + 1)], "id long")
    assert bounded_broadcast(small, small) is not small
    assert bounded_broadcast(big, big) is big
    table = spark.range(10)
    assert bounded_broadcast(table, table) is table
