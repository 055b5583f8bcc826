import datetime as dt
from decimal import Decimal

import numpy as np

from meterline.operators import forecast as FC


def _usage(spark, ys, gap_at=None):
    base = dt.datetime(2024, 1, 1)
    rows, day = [], 0
    for i, y in enumerate(ys):
        if gap_at is not None and i == gap_at:
            day += 1
        rows.append((base + dt.timedelta(days=day), 1, 1, "Pro", Decimal(str(y)), 1))
        day += 1
    return spark.createDataFrame(rows, "ts timestamp_ntz, app_id long, capability_id int, tier string, "
                                       "units_consumed decimal(12,2), nodes_count int")


def _loop(ys, periods=12, alpha=0.3):
    y = np.array(ys, dtype=float)
    x = np.arange(len(y), dtype=float)
    sxx = ((x - x.mean()) ** 2).sum()
    slope = ((x - x.mean()) * (y - y.mean())).sum() / sxx
    intercept = y.mean() - slope * x.mean()
    resid = y - (slope * x + intercept)
    se = np.sqrt((resid ** 2).sum() / (len(y) - 2) / sxx)
    fx = np.arange(len(y), len(y) + periods, dtype=float)
    lin = slope * fx + intercept
    half = 1.96 * se * np.sqrt(1 + 1 / len(y) + (fx - x.mean()) ** 2 / sxx)
    s = [y[0]]
    for v in y[1:]:
        s.append(alpha * v + (1 - alpha) * s[-1])
    ev = np.array([s[-1] + (s[-1] - s[-2]) * (k + 1) for k in range(periods)])
    sd = np.std(y)
    return 0.6 * lin + 0.4 * ev, 0.6 * (lin - half) + 0.4 * (ev - 1.96 * sd), 0.6 * (lin + half) + 0.4 * (ev + 1.96 * sd)


def test_ensemble_matches_loop(spark):
    rng = np.random.default_rng(3)
    ys = list(np.round(rng.uniform(10, 50, 35), 2))
    as_of = dt.date(2024, 2, 10)
    proj = FC.projections(FC.model_parameters(FC.history(_usage(spark, ys), as_of))).orderBy("i").collect()
    p, lo, hi = _loop(ys)
    assert len(proj) == 12
    for r, a, b, c in zip(proj, p, lo, hi):
        assert abs(r.ensemble - a) < 1e-6 and abs(r.ensemble_low - b) < 1e-6 and abs(r.ensemble_high - c) < 1e-6


def test_constant_series_zero_width_linear(spark):
    as_of = dt.date(2024, 2, 10)
    proj = FC.projections(FC.model_parameters(FC.history(_usage(spark, [5.0] * 30), as_of))).collect()
    assert all(abs(r.linear - 5.0) < 1e-12 and r.linear_low == r.linear_high for r in proj)


def test_gates_rows_and_days(spark):
    as_of = dt.date(2024, 2, 10)
    assert FC.history(_usage(spark, [1.0 + i for i in range(29)]), as_of).count() == 0
    h = FC.history(_usage(spark, [1.0 + i for i in range(30)], gap_at=10), as_of)
    # gap day is not filled: x stays 0..29 over the 30 days present
    xs = sorted(r.x for r in h.collect())
    assert xs == [float(i) for i in range(30)]


def test_ensemble_forecast_rows_and_months(spark):
    from meterline.sources import seeds
    as_of = dt.date(2024, 2, 10)
    f = FC.ensemble_forecast(_usage(spark, [1.0 + (i % 7) for i in range(40)]), seeds.prices(spark), as_of).collect()
    months = sorted(r.month_start for r in f)
    assert months[0] == dt.date(2024, 2, 1) and months[-1] == dt.date(2025, 1, 1) and len(f) == 12
