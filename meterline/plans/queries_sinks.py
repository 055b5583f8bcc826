"""Registered upsert queries: direct chargeback (to 2000-12) merged with a later batch
of direct + allocated chargeback (from 2000-07), keyed on (month, app, sector)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from meterline.operators.chargeback import CHARGEBACK_KEY
from meterline.plans import oracle as O
from meterline.plans.registry import register, star
from meterline.sources import sinks as SK

TARGET_END = dt.date(2001, 1, 1)
BATCH_START = dt.date(2000, 7, 1)


def _halves(spark, sf_dir):
    s = star(spark, sf_dir)
    target = s.chargeback.where(F.col("month_start") < F.lit(TARGET_END))
    batch = s.chargeback_all.where(F.col("month_start") >= F.lit(BATCH_START))
    return target, batch


def _out(df):
    return df.withColumn("usd_amount", F.col("usd_amount").cast("double"))


O.cte("cb_target", f"SELECT * FROM chargeback WHERE month_start < {O.sql_date(TARGET_END)}", "chargeback")
O.cte("cb_batch", f"SELECT * FROM chargeback_all WHERE month_start >= {O.sql_date(BATCH_START)}", "chargeback_all")
_ON = "o.month_start = n.month_start AND o.app_id = n.app_id AND o.sector_id = n.sector_id"
_COLS = ["month_start", "app_id", "h_code", "sector_id", "owner_id", "usd_amount", "chargeback_cycle"]


def _pick(c, measure_add=False):
    if measure_add and c == "usd_amount":
        return "CAST(COALESCE(o.usd_amount, 0) + COALESCE(n.usd_amount, 0) AS DOUBLE) AS usd_amount"
    expr = f"CASE WHEN n.app_id IS NOT NULL THEN n.{c} ELSE o.{c} END"
    return f"CAST({expr} AS DOUBLE) AS {c}" if c == "usd_amount" else f"{expr} AS {c}"


@register("upsert_replace", O.build(
    f"SELECT {', '.join(_pick(c) for c in _COLS)} FROM cb_target o FULL OUTER JOIN cb_batch n ON {_ON}",
    "cb_target", "cb_batch"))
def q_upsert_replace(spark, sf_dir):
    t, b = _halves(spark, sf_dir)
    return _out(SK.upsert_replace(t, b, CHARGEBACK_KEY))


@register("upsert_add", O.build(
    f"SELECT {', '.join(_pick(c, True) for c in _COLS)} FROM cb_target o FULL OUTER JOIN cb_batch n ON {_ON}",
    "cb_target", "cb_batch"))
def q_upsert_add(spark, sf_dir):
    t, b = _halves(spark, sf_dir)
    return _out(SK.upsert_add(t, b, CHARGEBACK_KEY, ["usd_amount"]))


@register("insert_if_absent", O.build(f"""
SELECT month_start, app_id, h_code, sector_id, owner_id, CAST(usd_amount AS DOUBLE) AS usd_amount, chargeback_cycle
FROM cb_target
UNION ALL
SELECT month_start, app_id, h_code, sector_id, owner_id, CAST(usd_amount AS DOUBLE), chargeback_cycle FROM cb_batch n
WHERE NOT EXISTS (SELECT 1 FROM cb_target o WHERE {_ON})""", "cb_target", "cb_batch"))
def q_insert_if_absent(spark, sf_dir):
    t, b = _halves(spark, sf_dir)
    return _out(SK.insert_if_absent(t, b, CHARGEBACK_KEY))


@register("upsert_tally", O.build(f"""
SELECT COUNT(*) FILTER (WHERE o.app_id IS NULL) AS inserted, COUNT(*) FILTER (WHERE o.app_id IS NOT NULL) AS updated
FROM cb_batch n LEFT JOIN cb_target o ON {_ON}""", "cb_target", "cb_batch"))
def q_upsert_tally(spark, sf_dir):
    t, b = _halves(spark, sf_dir)
    return SK.upsert_tally(t, b, CHARGEBACK_KEY)
