"""Usage forecasting (F01-F07), one pass over all keys.

Per (app, capability, tier) key the history is the daily mean of units over
the last ``window_days`` days -- at most ``window_days + 1`` points, so the
per-key arrays used below are bounded by the window, not by the data size.
Linear regression uses the SQL regression aggregates; exponential smoothing
is a higher-order ``aggregate`` fold over the date-sorted history (the same
arithmetic as the sequential loop); the ensemble is a projection. Nothing
leaves the executors.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from meterline.functions.timeutil import since, add_months, as_date, days_before, month_start, ts_lit
from meterline.operators.cost import with_rate_as_of
from meterline.session import bounded_broadcast

KEY = ["app_id", "capability_id", "tier"]

# --- fixed values ------------------------------------------------------------
WINDOW_DAYS = 90
MIN_ROWS = 30            # key needs >= 30 usage rows in the window
MIN_DAYS = 30            # ... and >= 30 distinct days of history
MIN_LINEAR_POINTS = 7
ALPHA = 0.3
Z = 1.96
LINEAR_WEIGHT = 0.6
SMOOTHING_WEIGHT = 0.4
HORIZON = 12
DAYS_PER_MONTH = 30
METHOD_RUNRATE = "linear_trend"
METHOD_ENSEMBLE = "ensemble_linear_exp"
# ---------------------------------------------------------------------------------

FORECAST_COLUMNS = ["month_start", "app_id", "capability_id", "tier", "projected_units", "projected_cost",
                    "confidence_interval_low", "confidence_interval_high", "method"]


def _window(usage: DataFrame, as_of, days: int) -> DataFrame:
    return since(usage, days_before(as_of, days))


def runrate_forecast(usage: DataFrame, prices: DataFrame, as_of, existing: DataFrame | None = None,
                     days: int = WINDOW_DAYS) -> DataFrame:
    """flat run-rate for months +1..+12 (inner price join at as_of; only keys not yet forecast)."""
    from meterline.operators.cost import price_as_of
    recent = (_window(usage, as_of, days).groupBy(*KEY)
              .agg(F.avg("units_consumed").alias("avg_units"), F.stddev_samp("units_consumed").alias("sd"),
                   F.count(F.lit(1)).alias("n"))
              .where(F.col("n") >= MIN_ROWS))
    base = month_start(as_date(as_of))
    months = F.explode(F.sequence(F.lit(1), F.lit(HORIZON))).alias("k")
    r = bounded_broadcast(price_as_of(prices, as_of), prices)
    f = (recent.select("*", months)
               .join(r, ["capability_id", "tier"], "inner")
               .select(F.add_months(F.lit(base), F.col("k")).alias("month_start"), *KEY,
                       F.round(F.col("avg_units") * 30, 2).cast("decimal(12,2)").alias("projected_units"),
                       F.round(F.col("avg_units") * 30 * F.col("unit_rate"), 2).cast("decimal(12,2)")
                        .alias("projected_cost"),
                       F.round((F.col("avg_units") - F.coalesce(F.col("sd"), F.lit(0.0))) * 30, 2)
                        .cast("decimal(12,2)").alias("confidence_interval_low"),
                       F.round((F.col("avg_units") + F.coalesce(F.col("sd"), F.lit(0.0))) * 30, 2)
                        .cast("decimal(12,2)").alias("confidence_interval_high"),
                       *[F.round((F.col("avg_units") + sign * F.coalesce(F.col("sd"), F.lit(0.0))) * 30 * F.col("unit_rate").cast("double"), 2)
                         .cast("decimal(12,2)").alias(c) for c, sign in (("cost_low", -1), ("cost_high", 1))],
                       F.lit(METHOD_RUNRATE).alias("method")))
    if existing is not None:
        f = f.join(existing.select("month_start", *KEY), ["month_start", *KEY], "left_anti")
    return f


def history(usage: DataFrame, as_of, days: int = WINDOW_DAYS) -> DataFrame:
    """per key, the daily mean units of the days present (gaps are not filled), x = 0..n-1."""
    w = _window(usage, as_of, days).where(F.col("tier").isNotNull() & F.col("capability_id").isNotNull())
    keys = (w.groupBy(*KEY).agg(F.count(F.lit(1)).alias("_rows")).where(F.col("_rows") >= MIN_ROWS)
             .select(*KEY))
    daily = (w.groupBy(*KEY, F.to_date("ts").alias("d"))
              .agg((F.sum("units_consumed").cast("double") / F.count("units_consumed")).alias("y")))
    daily = daily.join(keys, KEY, "left_semi")
    win = Window.partitionBy(*KEY).orderBy("d")
    h = daily.withColumn("x", (F.row_number().over(win) - 1).cast("double"))
    n = h.groupBy(*KEY).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= MIN_DAYS)
    return h.join(n, KEY)


def model_parameters(hist: DataFrame) -> DataFrame:
    """F03 + F04 parameters per key (one row per key)."""
    fold = F.aggregate(
        F.slice(F.col("ys"), 2, F.size("ys")),
        F.struct(F.element_at("ys", 1).alias("s"), F.element_at("ys", 1).alias("p")),
        lambda acc, y: F.struct((F.lit(ALPHA) * y + (F.lit(1.0) - F.lit(ALPHA)) * acc["s"]).alias("s"),
                                acc["s"].alias("p")))
    g = hist.groupBy(*KEY).agg(
        F.first("n").alias("n"),
        F.regr_slope("y", "x").alias("slope"), F.regr_intercept("y", "x").alias("intercept"),
        F.regr_sxx("y", "x").alias("sxx"), F.regr_syy("y", "x").alias("syy"), F.regr_sxy("y", "x").alias("sxy"),
        F.avg("x").alias("x_mean"), F.max("y").alias("y_max"), F.min("y").alias("y_min"),
        F.stddev_pop("y").alias("sigma"),
        F.transform(F.array_sort(F.collect_list(F.struct("x", "y"))), lambda e: e["y"]).alias("ys"))
    resid = (F.col("syy") - F.col("sxy") * F.col("sxy") / F.col("sxx")) / (F.col("n") - 2)
    return (g.withColumn("constant", F.col("y_max") == F.col("y_min"))
             .withColumn("y0", F.element_at("ys", 1))
             .withColumn("se", F.sqrt(F.greatest(resid, F.lit(0.0)) / F.col("sxx")))
             .withColumn("_fold", fold)
             .withColumn("smooth_last", F.col("_fold.s"))
             .withColumn("smooth_trend", F.col("_fold.s") - F.col("_fold.p"))
             .drop("_fold", "ys"))


def projections(params: DataFrame, horizon: int = HORIZON) -> DataFrame:
    """F03-F05 projections for steps i = 0..horizon-1 (x = n + i)."""
    i = F.explode(F.sequence(F.lit(0), F.lit(horizon - 1))).alias("i")
    p = params.where(F.col("n") >= MIN_LINEAR_POINTS).select("*", i)
    fx = F.col("n") + F.col("i")
    lin = F.when(F.col("constant"), F.col("y0")).otherwise(F.col("slope") * fx + F.col("intercept"))
    half = F.when(F.col("constant"), F.lit(0.0)).otherwise(
        F.lit(Z) * F.col("se") * F.sqrt(1 + 1 / F.col("n") + (fx - F.col("x_mean")) ** 2 / F.col("sxx")))
    exp_v = F.col("smooth_last") + F.col("smooth_trend") * (F.col("i") + 1)
    exp_h = F.lit(Z) * F.col("sigma")
    return p.select(
        *KEY, "i",
        lin.alias("linear"), (lin - half).alias("linear_low"), (lin + half).alias("linear_high"),
        exp_v.alias("smoothing"), (exp_v - exp_h).alias("smoothing_low"), (exp_v + exp_h).alias("smoothing_high"),
        (LINEAR_WEIGHT * lin + SMOOTHING_WEIGHT * exp_v).alias("ensemble"),
        (LINEAR_WEIGHT * (lin - half) + SMOOTHING_WEIGHT * (exp_v - exp_h)).alias("ensemble_low"),
        (LINEAR_WEIGHT * (lin + half) + SMOOTHING_WEIGHT * (exp_v + exp_h)).alias("ensemble_high"))


def ensemble_forecast(usage: DataFrame, prices: DataFrame, as_of, days: int = WINDOW_DAYS) -> DataFrame:
    """12 monthly rows per key starting with the as_of month; units x30, cost by rate (default 0.50)."""
    proj = projections(model_parameters(history(usage, as_of, days)))
    base = month_start(as_date(as_of))
    f = with_rate_as_of(proj, prices, as_of)
    return f.select(
        F.add_months(F.lit(base), F.col("i")).alias("month_start"), *KEY,
        F.round(F.col("ensemble") * DAYS_PER_MONTH, 2).cast("decimal(12,2)").alias("projected_units"),
        F.round(F.col("ensemble") * DAYS_PER_MONTH * F.col("unit_rate").cast("double"), 2)
         .cast("decimal(12,2)").alias("projected_cost"),
        F.round(F.col("ensemble_low") * DAYS_PER_MONTH, 2).cast("decimal(12,2)").alias("confidence_interval_low"),
        F.round(F.col("ensemble_high") * DAYS_PER_MONTH, 2).cast("decimal(12,2)").alias("confidence_interval_high"),
        # The bounds above are units; these are the same in money
        *[F.round(F.col(f"ensemble_{b}") * DAYS_PER_MONTH * F.col("unit_rate").cast("double"), 2).cast("decimal(12,2)").alias(f"cost_{b}")
          for b in ("low", "high")],
        F.lit(METHOD_ENSEMBLE).alias("method"))


def backtest_mape(forecast: DataFrame, usage: DataFrame, as_of) -> DataFrame:
    """last month's forecast vs actual units per (app, capability) (actuals not split by tier)."""
    m = month_start(add_months(as_date(as_of), -1))
    lo = dt.datetime.combine(m, dt.time())
    hi = dt.datetime.combine(add_months(m, 1), dt.time())
    f = forecast.where(F.col("month_start") == F.lit(m)).select("app_id", "capability_id", "projected_units")
    actual = (usage.where((F.col("ts") >= ts_lit(lo)) & (F.col("ts") < ts_lit(hi)))
                   .groupBy("app_id", "capability_id").agg(F.sum("units_consumed").alias("actual")))
    cmp = (f.join(actual, ["app_id", "capability_id"], "left")
            .groupBy("app_id", "capability_id", "projected_units")
            .agg(F.coalesce(F.sum("actual"), F.lit(0)).alias("actual_units")))
    err = F.abs(F.col("projected_units") - F.col("actual_units")).cast("double") \
        / F.col("actual_units").cast("double") * 100
    return (cmp.where(F.col("actual_units") > 0)
               .agg(F.round(F.avg(err), 6).alias("mape"), F.count(F.lit(1)).alias("sample_size")))
