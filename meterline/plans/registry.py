"""Registry of named queries (Spark) and their SQL oracle (DuckDB).

``QUERIES[name](spark, sf_dir) -> DataFrame``; ``ORACLE[name] -> SQL``.
Queries without an oracle entry are checked by row count only (and by
pytest against brute-force Python on small fixtures).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from meterline.operators import views as V
from meterline.plans import oracle as O
from meterline.sources.star import Star

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def star(spark: SparkSession, sf_dir: str) -> Star:
    return Star(spark, sf_dir)


# --- cost / chargeback -------------------------------------------------------
@register("cost_fact", O.build("SELECT ts, app_id, capability_id, tier, CAST(usd_cost AS DOUBLE) AS usd_cost, "
                               "price_id FROM cost", "cost"))
def q_cost_fact(spark, sf_dir):
    from pyspark.sql import functions as F
    c = star(spark, sf_dir).cost
    return c.withColumn("usd_cost", F.col("usd_cost").cast("double"))


# --- views -------------------------------------------------------------------
@register("v1_daily_cost", O.view("v1"))
def q_v1(spark, sf_dir):
    s = star(spark, sf_dir)
    return V.v1_daily_cost_by_controller(s.cost, s.app, s.as_of)


@register("v2_daily_usage", O.view("v2"))
def q_v2(spark, sf_dir):
    s = star(spark, sf_dir)
    return V.v2_daily_usage_by_capability(s.usage, s.app, s.capabilities, s.as_of)


@register("v3_cost_by_sector", O.view("v3"))
def q_v3(spark, sf_dir):
    s = star(spark, sf_dir)
    return V.v3_cost_by_sector_controller(s.cost, s.app, s.sectors, s.as_of)


@register("v4_cost_by_owner", O.view("v4"))
def q_v4(spark, sf_dir):
    s = star(spark, sf_dir)
    return V.v4_cost_by_owner_controller(s.cost, s.app, s.owners, s.as_of)


@register("v5_architecture", O.view("v5"))
def q_v5(spark, sf_dir):
    s = star(spark, sf_dir)
    return V.v5_architecture_metrics(s.usage, s.cost, s.app, s.architectures, s.capabilities, s.as_of)


@register("v5_exact", O.view("v5_exact"))
def q_v5_exact(spark, sf_dir):
    s = star(spark, sf_dir)
    return V.v5_architecture_metrics_exact(s.usage, s.cost, s.app, s.architectures, s.capabilities, s.as_of)


@register("v6_app_rankings", O.view("v6"))
def q_v6(spark, sf_dir):
    s = star(spark, sf_dir)
    return V.v6_app_cost_rankings_monthly(s.cost, s.app, s.sectors, s.owners, s.as_of)


@register("v7_chargeback_summary", O.view("v7"))
def q_v7(spark, sf_dir):
    return star(spark, sf_dir).v7


@register("v8_peak_pro", O.view("v8"))
def q_v8(spark, sf_dir):
    s = star(spark, sf_dir)
    return V.v8_peak_pro_comparison(s.cost, s.app, s.as_of)
