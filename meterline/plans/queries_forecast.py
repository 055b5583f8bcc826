"""Registered forecasting queries (events star)."""

from __future__ import annotations

from pyspark.sql import functions as F

from meterline.operators import forecast as FC
from meterline.plans import forecast_sql
from meterline.plans.registry import register
from meterline.sources.star import Star

KEY = FC.KEY


def _ev(spark, sf_dir):
    return Star.events(spark, sf_dir)


def _dbl(df, *cols):
    for c in cols:
        df = df.withColumn(c, F.col(c).cast("double"))
    return df


_AMOUNTS = ("projected_units", "projected_cost", "confidence_interval_low", "confidence_interval_high", "cost_low",
            "cost_high")


@register("forecast_runrate", forecast_sql.SQL["forecast_runrate"])
def q_runrate(spark, sf_dir):
    s = _ev(spark, sf_dir)
    return _dbl(FC.runrate_forecast(s.usage, s.price, s.as_of), *_AMOUNTS)


@register("forecast_linear", forecast_sql.SQL["forecast_linear"])
def q_linear(spark, sf_dir):
    s = _ev(spark, sf_dir)
    params = FC.model_parameters(FC.history(s.usage, s.as_of))
    proj = FC.projections(params).where(F.col("i") == 0)
    return (proj.join(params, KEY)
                .select(*KEY, F.col("n").cast("bigint").alias("n"), F.round("slope", 6).alias("slope"),
                        F.round("intercept", 4).alias("intercept"),
                        F.round("linear", 4).alias("first_projection"),
                        F.round(F.col("linear_high") - F.col("linear"), 4).alias("first_half_width")))


@register("forecast_smoothing", forecast_sql.SQL["forecast_smoothing"])
def q_smoothing(spark, sf_dir):
    s = _ev(spark, sf_dir)
    params = FC.model_parameters(FC.history(s.usage, s.as_of))
    return params.select(*KEY, F.round("smooth_last", 4).alias("smooth_last"),
                         F.round("smooth_trend", 4).alias("smooth_trend"), F.round("sigma", 4).alias("sigma"))


@register("forecast_ensemble", forecast_sql.SQL["forecast_ensemble"])
def q_ensemble(spark, sf_dir):
    s = _ev(spark, sf_dir)
    return _dbl(s.forecast, *_AMOUNTS)


@register("forecast_mape", forecast_sql.SQL["forecast_mape"])
def q_mape(spark, sf_dir):
    s = _ev(spark, sf_dir)
    return FC.backtest_mape(s.forecast, s.usage, forecast_sql.BACKTEST_AS_OF)
