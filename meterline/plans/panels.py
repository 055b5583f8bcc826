"""Dashboard panel queries D01-D62 over the reporting tables.

Every panel is ``f(src, params) -> DataFrame``. ``src`` exposes the views
(V1-V8) and facts as DataFrames -- freshly derived, or read back from the
published tables -- so a panel is a small aggregate over a pre-aggregated
table. Optional filters are added only when set ('All' means no predicate,
so nothing blocks pushdown). Every top-k has a full tie-break.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterline.functions import rules
from meterline.functions.timeutil import add_months, as_date, month_start, ts_lit
from meterline.session import bounded_broadcast

PANELS: dict[str, callable] = {}


def panel(name):
    def deco(fn):
        PANELS[name] = fn
        return fn
    return deco


@dataclass
class PanelParams:
    as_of: dt.date
    controller: str | None = None           # single-select; None = 'All'
    controllers: list[str] | None = None    # multi-select; None = every known controller
    time_from: dt.date | None = None        # picker; default as_of - 90 days
    time_to: dt.date | None = None          # picker; default as_of
    forecast_method: str = "ensemble_linear_exp"

    def __post_init__(self):
        self.as_of = as_date(self.as_of)
        if self.time_from is None:
            self.time_from = self.as_of - dt.timedelta(days=90)
        if self.time_to is None:
            self.time_to = self.as_of


def money(c: Column) -> Column:
    """Sums of cent amounts: round to cents so engines agree to the bit."""
    return F.round(c, 2)


def ratio(c: Column) -> Column:
    return F.round(c, 6)


def _ctl(df: DataFrame, p: PanelParams, col: str = "controller") -> DataFrame:
    return df if p.controller is None else df.where(F.col(col) == p.controller)


def _ctl_list(df: DataFrame, src, p: PanelParams, col: str = "controller") -> DataFrame:
    if p.controllers is not None:
        return df.where(F.col(col).isin(*p.controllers))
    known = src.app.where(F.col("controller").isNotNull()).select(F.col("controller").alias("_kc")).distinct()
    return df.join(known, F.col(col) == F.col("_kc"), "left_semi")


def _pick(df: DataFrame, p: PanelParams, col: str) -> DataFrame:
    return df.where((F.col(col) >= F.lit(p.time_from)) & (F.col(col) <= F.lit(p.time_to)))


def _picked_chargeback(src, p: PanelParams) -> DataFrame:
    """Direct chargeback of the picker's months."""
    return src.chargeback_from(month_start(p.time_from), add_months(month_start(p.time_to), 1))


def _latest_month(v7: DataFrame) -> Column:
    """Scalar subquery MAX(month_start) of the chargeback summary."""
    return v7.select(F.max("month_start")).scalar()


def _mr(src, p) -> DataFrame:
    v7 = src.v7
    return _ctl(v7.where(F.col("month_start") == _latest_month(v7)), p)


def _ordered(df: DataFrame, *cols: str) -> DataFrame:
    """Time-series panels come back ordered (ascending, NULLs last as in PostgreSQL)."""
    return df.orderBy(*[F.col(c).asc_nulls_last() for c in cols])


def _top(df: DataFrame, k: int, *order: Column) -> DataFrame:
    return df.orderBy(*order).limit(k)


# --- Allocation & chargeback ---------------------------------------------------
@panel("d01_last_month_total")
def d01(src, p):
    return _mr(src, p).agg(money(F.sum("total_amount")).alias("total_chargeback"))


@panel("d02_sectors_billed")
def d02(src, p):
    return (_mr(src, p).where(F.col("sector_name") != "Unknown")
            .agg(F.countDistinct("sector_name").alias("sectors_charged")))


@panel("d03_avg_per_sector")
def d03(src, p):
    return (_mr(src, p).where(F.col("sector_name") != "Unknown")
            .agg(ratio(F.avg("total_amount")).alias("avg_per_sector")))


def _sector_totals(src, p, value_name):
    return _mr(src, p).groupBy("sector_name").agg(money(F.sum("total_amount")).alias(value_name))


@panel("d04_top10_sectors")
def d04(src, p):
    g = _sector_totals(src, p, "value").withColumnRenamed("sector_name", "metric")
    return _top(g, 10, F.col("value").desc_nulls_first(), F.col("metric").asc_nulls_last())


@panel("d05_top15_sectors")
def d05(src, p):
    g = _sector_totals(src, p, "chargeback_amount")
    return _top(g, 15, F.col("chargeback_amount").desc_nulls_first(), F.col("sector_name").asc_nulls_last())


@panel("d06_top5_sector_trend")
def d06(src, p):
    """One pass over V7: its sums by month and sector (25 months, few sectors) hold the newest month, the best
    sectors in it and their trend."""
    mine = F.lit(True) if p.controller is None else F.col("controller") == p.controller
    sums = src.v7.groupBy("month_start", "sector_name").agg(
        F.sum("total_amount").alias("_all"), F.sum(F.when(mine, F.col("total_amount"))).alias("_own"), F.count_if(mine).alias("_rows"))
    # a window over all of these few sums
    sums = sums.withColumn("_newest", F.max("month_start").over(Window.partitionBy(F.lit(0))))
    now = F.col("month_start") == F.col("_newest")
    sectors = (sums.groupBy("sector_name").agg(
        F.max(F.when(now, F.col("_all"))).alias("_t"), F.count_if(now).alias("_here"), F.first("_newest").alias("_newest"),
        F.collect_list(F.struct("month_start", "_own", "_rows")).alias("_months")))              # 25 at most
    top5 = (sectors.where(F.col("_here") > 0).orderBy(F.col("_t").desc_nulls_first(), F.col("sector_name").asc_nulls_last()).limit(5)
            .select("sector_name", "_newest", F.inline("_months")))
    trend = top5.where((F.col("_rows") > 0) & (F.col("month_start") >= F.trunc(F.add_months("_newest", -12), "MM")))
    return _ordered(trend.select(F.col("month_start").alias("time"), F.col("sector_name").alias("metric"), money(F.col("_own")).alias("value")),
                    "time", "metric")


@panel("d07_top20_apps")
def d07(src, p):
    j = _ctl(src.newest_chargeback().join(src.app.select("app_id", "app_name", "controller"), "app_id"), p)
    g = j.groupBy("app_name").agg(money(F.sum("usd_amount").cast("double")).alias("cost"))
    return _top(g, 20, F.col("cost").desc_nulls_first(), F.col("app_name").asc_nulls_last())


@panel("d08_app_count_by_sector")
def d08(src, p):
    return (_mr(src, p).groupBy("sector_name").agg(F.sum("app_count").cast("bigint").alias("value"))
            .select(F.col("sector_name").alias("metric"), "value"))


@panel("d09_chargeback_trend_24m")
def d09(src, p):
    lo = month_start(add_months(p.as_of, -24))
    d = _ctl(src.v7.where(F.col("month_start") >= F.lit(lo)), p)
    return _ordered((d.groupBy("month_start").agg(money(F.sum("total_amount")).alias("value"))
             .select(F.col("month_start").alias("time"), F.lit("Total Chargeback").alias("metric"), "value")), "time")



@panel("d10_hcode_coverage")
def d10(src, p):
    hit = F.count_if(F.col("h_code").isNotNull() & (F.col("h_code") != "Unknown")).cast("double")
    return _mr(src, p).agg(ratio(F.try_divide(hit, F.nullif(F.count(F.lit(1)), F.lit(0))))
                           .alias("h_code_coverage"))


def _hcode_totals(src, p):
    return (_mr(src, p).groupBy("h_code")
            .agg(money(F.sum("total_amount")).alias("_v"))
            .select(F.coalesce(F.col("h_code"), F.lit("Not Configured")).alias("_h"), "_v", "h_code"))


@panel("d11_cost_by_hcode")
def d11(src, p):
    g = _hcode_totals(src, p)
    return _top(g, 15, F.col("_v").desc_nulls_first(), F.col("_h").asc_nulls_last()) \
        .select(F.col("_h").alias("metric"), F.col("_v").alias("value"))


@panel("d12_top20_hcodes")
def d12(src, p):
    g = _hcode_totals(src, p)
    return _top(g, 20, F.col("_v").desc_nulls_first(), F.col("_h").asc_nulls_last()) \
        .select(F.col("_h").alias("h_code"), F.col("_v").alias("cost"))


def _cycles(src, p):
    lo = month_start(add_months(p.as_of, -12))
    cb = src.chargeback_all_from(lo)
    return _ctl(cb.join(src.app.select("app_id", "controller"), "app_id"), p)


@panel("d13_direct_vs_shared")
def d13(src, p):
    """Literal: grouped by the raw cycle, labelled after (R9: several rows may share a label)."""
    g = _cycles(src, p).groupBy("month_start", "chargeback_cycle").agg(F.sum("usd_amount").alias("_v"))
    return _ordered(g.select(F.col("month_start").alias("time"), rules.cycle_label("chargeback_cycle").alias("metric"),
                    money(F.col("_v").cast("double")).alias("value")), "time")



@panel("d13_direct_vs_shared_fixed")
def d13_fixed(src, p):
    g = (_cycles(src, p).groupBy("month_start", rules.cycle_label_fixed("chargeback_cycle").alias("metric"))
         .agg(money(F.sum("usd_amount").cast("double")).alias("value")))
    return _ordered(g.select(F.col("month_start").alias("time"), "metric", "value"), "time", "metric")



# --- Architecture -------------------------------------------------------------
def _arch(src, p):
    return _ctl(src.v5, p).groupBy("architecture_name")


@panel("d14_architecture_efficiency")
def d14(src, p):
    apps, units, cost = F.sum("app_count"), F.sum("total_units"), F.sum("total_cost")
    g = _arch(src, p).agg(
        apps.cast("bigint").alias("app_count"),
        money(F.coalesce(units, F.lit(0.0))).alias("total_units"),
        F.round(F.avg("avg_nodes"), 2).alias("avg_nodes"),
        ratio(F.coalesce(F.sum("units_per_node"), F.lit(0.0))).alias("units_per_node"),
        money(F.coalesce(cost, F.lit(0.0))).alias("total_cost"),
        ratio(F.when(apps > 0, cost / apps).otherwise(F.lit(0.0))).alias("cost_per_app"),
        (units > 0).alias("_u"), (cost > 0).alias("_c"))
    return (g.where((F.col("app_count") > 0) & (F.col("_u") | F.col("_c")))
             .drop("_u", "_c").withColumnRenamed("architecture_name", "architecture"))


@panel("d15_cost_per_app")
def d15(src, p):
    apps, cost = F.sum("app_count"), F.sum("total_cost")
    g = _arch(src, p).agg(ratio(F.when(apps > 0, F.try_divide(cost, F.nullif(apps, F.lit(0))))
                                .otherwise(F.lit(0.0))).alias("cost"), apps.alias("_a"))
    return g.where(F.col("_a") > 0).select(F.col("architecture_name").alias("architecture_pattern"), "cost")


@panel("d16_app_count")
def d16(src, p):
    g = _arch(src, p).agg(F.sum("app_count").cast("bigint").alias("count"))
    return g.where(F.col("count") > 0).select(F.col("architecture_name").alias("architecture_pattern"), "count")


@panel("d17_total_cost")
def d17(src, p):
    g = _arch(src, p).agg(money(F.coalesce(F.sum("total_cost"), F.lit(0.0))).alias("total_cost"),
                          F.sum("total_cost").alias("_c"))
    return g.where(F.col("_c") > 0).select(F.col("architecture_name").alias("architecture_pattern"), "total_cost")


def _as_int(c: Column) -> Column:
    """PostgreSQL ``numeric::integer`` rounds half away from zero."""
    return F.round(c, 0).cast("int")


@panel("d18_units_per_app")
def d18(src, p):
    def per_app(code):
        return F.max(F.when(F.col("capability_code") == code,
                            F.try_divide(F.col("total_units"), F.nullif(F.col("app_count"), F.lit(0)))))
    apm_apps = F.max(F.when(F.col("capability_code") == "APM", F.col("app_count")))
    g = _arch(src, p).agg(
        F.max(F.when(F.col("capability_code") == "APM", F.col("app_count")).otherwise(F.lit(0)))
         .cast("bigint").alias("app_count"),
        _as_int(F.coalesce(per_app("APM"), F.lit(0.0))).alias("apm_units_per_app"),
        _as_int(F.coalesce(per_app("MRUM"), F.lit(0.0))).alias("mrum_units_per_app"),
        _as_int(F.coalesce(per_app("Synthetic"), F.lit(0.0))).alias("synthetic_units_per_app"),
        _as_int(F.coalesce(per_app("DB"), F.lit(0.0))).alias("db_units_per_app"),
        _as_int(F.coalesce(F.try_divide(F.sum("total_units"), F.nullif(apm_apps, F.lit(0))), F.lit(0.0)))
         .alias("total_units_per_app"),
        apm_apps.alias("_apm"))
    return g.where(F.col("_apm") > 0).drop("_apm").withColumnRenamed("architecture_name", "architecture")


@panel("d19_daily_units_by_architecture")
def d19(src, p):
    """Literal R10 fan-out (V2 x apps of the same controller), computed without the product:
    units(day, controller) x number of apps of each pattern on that controller."""
    v2 = _pick(src.v2, p, "usage_date")
    daily = v2.groupBy("usage_date", "controller").agg(F.sum("total_units").alias("_u"))
    arch = bounded_broadcast(src.architectures.select(F.col("architecture_id").alias("_ak"), "pattern_name"), src.architectures)
    per_ctl = (src.app.where(F.col("controller").isNotNull())
               .join(arch, F.col("architecture_id") == F.col("_ak"), "left")
               .groupBy(F.col("controller").alias("_ctl"), "pattern_name")
               .agg(F.count(F.lit(1)).alias("_n")))
    j = daily.join(per_ctl, F.col("controller") == F.col("_ctl"), "left")
    return _ordered((j.groupBy("usage_date", "pattern_name")
             .agg(money(F.sum(F.col("_u") * F.coalesce(F.col("_n"), F.lit(1)))).alias("value"))
             .select(F.col("usage_date").alias("time"),
                     F.coalesce(F.col("pattern_name"), F.lit("Unknown")).alias("metric"), "value")), "time", "metric")



@panel("d19_daily_units_by_architecture_fixed")
def d19_fixed(src, p):
    """R10 corrected: each app's own usage attributed to its own architecture."""
    u = src.usage.where((F.col("ts") >= F.lit(p.time_from).cast("timestamp_ntz"))
                        & (F.col("ts") < F.lit(p.time_to + dt.timedelta(days=1)).cast("timestamp_ntz")))
    u = u.groupBy(F.to_date("ts").alias("time"), "app_id").agg(F.sum("units_consumed").alias("_u"))
    a = _ctl(src.app, p).select("app_id", "architecture_id")
    arch = bounded_broadcast(src.architectures.select(F.col("architecture_id").alias("_ak"), "pattern_name"), src.architectures)
    j = u.join(a, "app_id").join(arch, F.col("architecture_id") == F.col("_ak"), "left")
    return _ordered((j.groupBy("time", "pattern_name").agg(money(F.sum("_u").cast("double")).alias("value"))
             .select("time", F.coalesce(F.col("pattern_name"), F.lit("Unknown")).alias("metric"), "value")), "time", "metric")



# --- Cost analytics -------------------------------------------------------------
def _v1p(src, p):
    return _ctl(_pick(src.v1, p, "cost_date"), p)


@panel("d20_total_cost")
def d20(src, p):
    return _v1p(src, p).agg(money(F.coalesce(F.sum("total_cost"), F.lit(0.0))).alias("total_cost"))


@panel("d21_avg_daily_cost")
def d21(src, p):
    return _v1p(src, p).agg(ratio(F.coalesce(F.avg("total_cost"), F.lit(0.0))).alias("avg_daily_cost"))


@panel("d22_peak_day_cost")
def d22(src, p):
    return _v1p(src, p).agg(F.coalesce(F.max("total_cost"), F.lit(0.0)).alias("peak_day_cost"))


@panel("d23_avg_cost_per_app")
def d23(src, p):
    return _v1p(src, p).agg(ratio(F.coalesce(F.try_divide(F.sum("total_cost"), F.nullif(F.sum("app_count"), F.lit(0))),
                                             F.lit(0.0))).alias("avg_cost_per_app"))


@panel("d24_cost_trend_by_sector")
def d24(src, p):
    d = _ctl(_pick(src.v3, p, "cost_date"), p)
    return _ordered((d.groupBy("cost_date", "sector_name").agg(money(F.coalesce(F.sum("total_cost"), F.lit(0.0))).alias("value"))
             .select(F.col("cost_date").alias("time"), F.col("sector_name").alias("metric"), "value")), "time", "metric")



@panel("d25_top_sectors")
def d25(src, p):
    d = _ctl(_pick(src.v3, p, "cost_date"), p)
    g = d.groupBy("sector_name").agg(money(F.coalesce(F.sum("total_cost"), F.lit(0.0))).alias("total_cost"))
    return _top(g, 10, F.col("total_cost").desc_nulls_first(), F.col("sector_name").asc_nulls_last()) \
        .withColumnRenamed("sector_name", "sector")


@panel("d26_top_owners")
def d26(src, p):
    d = _ctl(_pick(src.v4, p, "cost_date"), p)
    g = d.groupBy("owner_name").agg(money(F.coalesce(F.sum("total_cost"), F.lit(0.0))).alias("total_cost"))
    return _top(g, 10, F.col("total_cost").desc_nulls_first(), F.col("owner_name").asc_nulls_last()) \
        .withColumnRenamed("owner_name", "owner")


@panel("d27_cost_by_license_type")
def d27(src, p):
    g = _v1p(src, p).groupBy("tier").agg(money(F.coalesce(F.sum("total_cost"), F.lit(0.0))).alias("total"),
                                          F.sum("total_cost").alias("_s"))
    return g.where(F.col("_s") > 0).select(rules.tier_label("tier").alias("license_type"), "total")


@panel("d28_cost_by_tier")
def d28(src, p):
    g = _v1p(src, p).groupBy("tier").agg(money(F.coalesce(F.sum("total_cost"), F.lit(0.0))).alias("total"),
                                          F.sum("total_cost").alias("_s"))
    return g.where(F.col("_s") > 0).select("tier", "total")


# --- Executive -------------------------------------------------------------------
@panel("d29_monthly_spend")
def d29(src, p):
    cb = _picked_chargeback(src, p)
    if p.controller is not None:
        on_ctl = src.app.where(F.col("controller") == p.controller).select("app_id")
        cb = cb.join(on_ctl, "app_id", "left_semi")
    return cb.agg(money(F.coalesce(F.sum("usd_amount").cast("double"), F.lit(0.0))).alias("monthly_spend"))


@panel("d30_apps_monitored")
def d30(src, p):
    return _ctl(src.app.where(F.col("app_name").isNotNull()), p).agg(F.count(F.lit(1)).alias("applications"))


@panel("d31_cmdb_match_rate")
def d31(src, p):
    mon = F.count_if(F.col("monitoring_id").isNotNull())
    both = F.count_if(F.col("monitoring_id").isNotNull() & F.col("cmdb_id").isNotNull())
    return _ctl(src.app, p).agg(ratio(F.when(mon == 0, F.lit(0.0))
                                      .otherwise(both.cast("double") / mon.cast("double") * 100)).alias("match_rate"))


def _mom(src, p, keep_last_30: bool):
    lo60 = p.as_of - dt.timedelta(days=60)
    lo30 = p.as_of - dt.timedelta(days=30)
    daily = (_ctl(src.v1.where(F.col("cost_date") >= F.lit(lo60)), p)
             .groupBy(F.col("cost_date").alias("day")).agg(F.sum("total_cost").alias("daily_cost")))
    if keep_last_30:
        daily = daily.orderBy(F.col("day").desc()).limit(30)
    per = daily.agg(F.avg(F.when(F.col("day") >= F.lit(lo30), F.col("daily_cost"))).alias("r"),
                    F.avg(F.when(F.col("day") < F.lit(lo30), F.col("daily_cost"))).alias("q"))
    return per.select(ratio(F.when(F.col("q").isNull() | (F.col("q") == 0), F.lit(0.0))
                            .otherwise((F.col("r") - F.col("q")) / F.col("q") * 100)).alias("cost_trend"))


@panel("d32_cost_trend_mom")
def d32(src, p):
    """Literal (R11): only the latest 30 days survive the inner LIMIT, so 'previous' is mostly empty."""
    return _mom(src, p, True)


@panel("d32_cost_trend_mom_fixed")
def d32_fixed(src, p):
    return _mom(src, p, False)


@panel("d33_daily_cost_trend")
def d33(src, p):
    return _ordered((_v1p(src, p).groupBy("cost_date").agg(money(F.coalesce(F.sum("total_cost"), F.lit(0.0))).alias("value"))
            .select(F.col("cost_date").alias("time"), F.lit("Daily Cost").alias("metric"), "value")), "time")



@panel("d34_distribution_by_sector")
def d34(src, p):
    cb = _picked_chargeback(src, p)
    s = bounded_broadcast(src.sectors.select(F.col("sector_id").alias("_sk"), "sector_name"), src.sectors)
    j = _ctl(cb.join(s, F.col("sector_id") == F.col("_sk"), "left")
               .join(src.app.select("app_id", "controller"), "app_id"), p)
    g = j.groupBy("sector_name").agg(F.sum("usd_amount").alias("_s"))
    return g.where(F.col("_s") > 0).select(F.coalesce(F.col("sector_name"), F.lit("Unknown")).alias("sector"),
                                           money(F.col("_s").cast("double")).alias("total"))


@panel("d35_top10_apps")
def d35(src, p):
    lo = dt.datetime.combine(month_start(p.time_from), dt.time())
    hi = dt.datetime.combine(add_months(month_start(p.time_to), 1), dt.time())
    c = (src.cost.where((F.col("ts") >= ts_lit(lo)) & (F.col("ts") < ts_lit(hi)))
             .groupBy("app_id").agg(F.sum("usd_cost").alias("_c")))
    s = bounded_broadcast(src.sectors.select(F.col("sector_id").alias("_sk"), "sector_name"), src.sectors)
    a = _ctl(src.app.where(F.col("app_name").isNotNull()), p)
    j = a.join(s, F.col("sector_id") == F.col("_sk"), "left").join(c, "app_id", "left")
    g = j.groupBy("app_name", "sector_name").agg(F.sum("_c").alias("_t"))
    g = g.where(F.col("_t") > 0).select(
        F.col("app_name").alias("application"),
        F.coalesce(F.col("sector_name"), F.lit("Unknown")).alias("sector"),
        money(F.col("_t").cast("double")).alias("total_cost"))
    return _top(g, 10, F.col("total_cost").desc_nulls_first(), F.col("application").asc_nulls_last(),
                F.col("sector").asc_nulls_last())


# --- Peak vs Pro --------------------------------------------------------------------
def _tier_is(name):
    return F.upper(F.coalesce(F.col("tier"), F.lit(""))) == name


@panel("d36_peak_cost")
def d36(src, p):
    return _v1p(src, p).where(_tier_is("PEAK")).agg(
        money(F.coalesce(F.sum("total_cost"), F.lit(0.0))).alias("peak_tier_cost"))


@panel("d37_pro_cost")
def d37(src, p):
    return _v1p(src, p).where(_tier_is("PRO")).agg(
        money(F.coalesce(F.sum("total_cost"), F.lit(0.0))).alias("pro_tier_cost"))


@panel("d38_potential_savings")
def d38(src, p):
    return _v1p(src, p).where(_tier_is("PEAK")).agg(
        ratio(F.coalesce(F.round(F.sum("total_cost"), 2) * F.lit(0.33), F.lit(0.0))).alias("potential_savings"))


@panel("d39_peak_share")
def d39(src, p):
    t = _v1p(src, p).agg(F.round(F.sum(F.when(_tier_is("PEAK"), F.col("total_cost")).otherwise(F.lit(0.0))), 2).alias("pk"),
                         F.round(F.sum("total_cost"), 2).alias("tot"))
    return t.select(ratio(F.when(F.col("tot") == 0, F.lit(0.0))
                          .otherwise(F.try_divide(F.col("pk"), F.nullif(F.col("tot"), F.lit(0.0))) * 100)).alias("peak_pct"))


@panel("d40_peak_pro_trend")
def d40(src, p):
    t = rules.tier_norm("tier")
    return _ordered((_v1p(src, p).groupBy("cost_date", t.alias("metric"))
            .agg(money(F.coalesce(F.sum("total_cost"), F.lit(0.0))).alias("value"))
            .select(F.col("cost_date").alias("time"), "metric", "value")), "time", "metric")



@panel("d41_distribution_by_tier")
def d41(src, p):
    g = (_v1p(src, p).groupBy(rules.tier_norm("tier").alias("tier"))
         .agg(money(F.coalesce(F.sum("total_cost"), F.lit(0.0))).alias("total"), F.sum("total_cost").alias("_s")))
    return g.where(F.col("_s") > 0).drop("_s")


@panel("d42_top10_peak_apps")
def d42(src, p):
    lo = month_start(add_months(p.as_of, -3))
    d = _ctl(src.v6.where((F.col("cost_tier") == "Peak") & (F.col("month_start") >= F.lit(lo))), p)
    d = _top(d, 10, F.col("total_cost").desc_nulls_first(), F.col("app_id").asc(), F.col("month_start").asc())
    return d.select(F.col("app_name").alias("application"), F.col("sector_name").alias("sector"),
                    F.col("total_cost").alias("peak_cost"),
                    ratio(F.col("total_cost") * F.lit(0.33)).alias("potential_savings"))


# --- Trends -------------------------------------------------------------------------
@panel("d43_cost_trend_24m")
def d43(src, p):
    lo = add_months(p.as_of, -24)
    d = _ctl_list(src.v1.where(F.col("cost_date") >= F.lit(lo)), src, p)
    return _ordered((d.groupBy("cost_date").agg(money(F.sum("total_cost")).alias("total_cost"))
             .withColumnRenamed("cost_date", "time")), "time")



@panel("d44_sector_trend_24m")
def d44(src, p):
    lo = add_months(p.as_of, -24)
    d = _ctl_list(src.v3.where(F.col("cost_date") >= F.lit(lo)), src, p)
    return _ordered((d.groupBy("cost_date", "sector_name").agg(money(F.sum("total_cost")).alias("value"))
             .select(F.col("cost_date").alias("time"), F.col("sector_name").alias("metric"), "value")), "time", "metric")



@panel("d45_usage_by_type_24m")
def d45(src, p):
    lo = add_months(p.as_of, -24)
    d = _ctl_list(src.v2.where(F.col("usage_date") >= F.lit(lo)), src, p)
    return _ordered((d.groupBy("usage_date", "capability_code").agg(money(F.sum("total_units")).alias("value"))
             .select(F.col("usage_date").alias("time"), F.col("capability_code").alias("metric"), "value")), "time", "metric")



@panel("d51_app_count_projection")
def d51(src, p):
    """Literal (R14): COUNT(DISTINCT app_count) -- distinct values, not apps."""
    lo = add_months(p.as_of, -12)
    d = _ctl_list(src.v1.where(F.col("cost_date") >= F.lit(lo)), src, p)
    return _ordered((d.groupBy(F.trunc("cost_date", "MM").alias("time"))
             .agg(F.countDistinct("app_count").alias("value"))
             .select("time", F.lit("Historical Apps").alias("metric"), "value")), "time")



@panel("d51_app_count_projection_fixed")
def d51_fixed(src, p):
    lo = dt.datetime.combine(add_months(p.as_of, -12), dt.time())
    c = src.cost.where(F.col("ts") >= ts_lit(lo))
    a = src.app.select("app_id", "controller")
    j = _ctl_list(c.join(a, "app_id"), src, p)
    # distinct apps per month: dedupe (month, app) first, then count rows
    per = j.select(F.trunc("ts", "MM").alias("time"), "app_id").distinct()
    return _ordered((per.groupBy("time").agg(F.count(F.lit(1)).alias("value"))
               .select("time", F.lit("Historical Apps").alias("metric"), "value")), "time")



# --- Usage ----------------------------------------------------------------------------
def _v2p(src, p):
    return _ctl(_pick(src.v2, p, "usage_date"), p)


def _cap_units(code, out):
    def f(src, p):
        return (_v2p(src, p).where(F.col("capability_code") == code)
                .agg(money(F.coalesce(F.sum("total_units"), F.lit(0.0))).alias(out)))
    return f


PANELS["d52_apm_units"] = _cap_units("APM", "apm_units")
PANELS["d53_mrum_units"] = _cap_units("MRUM", "mrum_units")
PANELS["d54_synthetic_units"] = _cap_units("Synthetic", "synthetic_units")
PANELS["d55_db_units"] = _cap_units("DB", "db_units")


@panel("d56_usage_trend")
def d56(src, p):
    return _ordered((_v2p(src, p).groupBy("usage_date", "capability_code")
            .agg(money(F.coalesce(F.sum("total_units"), F.lit(0.0))).alias("value"))
            .select(F.col("usage_date").alias("time"), F.col("capability_code").alias("metric"), "value")), "time", "metric")



@panel("d57_peak_units")
def d57(src, p):
    return _v2p(src, p).where(_tier_is("PEAK")).agg(
        money(F.coalesce(F.sum("total_units"), F.lit(0.0))).alias("peak_tier_total_units"))


@panel("d58_pro_units")
def d58(src, p):
    return _v2p(src, p).where(_tier_is("PRO")).agg(
        money(F.coalesce(F.sum("total_units"), F.lit(0.0))).alias("pro_tier_total_units"))


@panel("d59_top10_apps_by_usage")
def d59(src, p):
    """R15 corrected: true top-10 applications by units in the picker window."""
    lo = dt.datetime.combine(p.time_from, dt.time())
    hi = dt.datetime.combine(p.time_to, dt.time())
    u = (src.usage.where((F.col("ts") >= ts_lit(lo)) & (F.col("ts") <= ts_lit(hi)))
              .groupBy("app_id").agg(F.sum("units_consumed").alias("_u")))
    a = _ctl(src.app.where(F.col("app_name").isNotNull()), p).select("app_id", "app_name")
    g = (u.join(a, "app_id").groupBy("app_name").agg(F.sum("_u").alias("_t"))
          .where(F.col("_t") > 0)
          .select(F.col("app_name").alias("application"), money(F.col("_t").cast("double")).alias("total_units")))
    return _top(g, 10, F.col("total_units").desc_nulls_first(), F.col("application").asc_nulls_last())


# --- Pickers ----------------------------------------------------------------------------
@panel("d60_controller_picker")
def d60(src, p):
    ctl = src.app.where(F.col("controller").isNotNull()).select("controller")
    return _ordered(src.spark.createDataFrame([("All",)], "controller string").union(ctl).distinct(), "controller")



@panel("d61_sector_picker")
def d61(src, p):
    # the sectors that applications are in
    s = (src.sectors.where(F.col("sector_name").isNotNull())
            .join(src.app.select("sector_id"), "sector_id", "left_semi").select("sector_name"))
    return _ordered(src.spark.createDataFrame([("All",)], "sector_name string").union(s).distinct(), "sector_name")



@panel("d62_controller_list")
def d62(src, p):
    return _ordered(src.app.where(F.col("controller").isNotNull()).select("controller").distinct(), "controller")



# --- Forecast panels (events star: costs and forecasts share one as_of) ----------------
def _forecast_ctl(src, p):
    f = src.forecast.join(src.app.select("app_id", "controller"), "app_id")
    return _ctl_list(f, src, p)


@panel("d46_forecast_vs_actual")
def d46(src, p):
    lo = add_months(p.as_of, -6)
    actual = (_ctl_list(src.v1.where(F.col("cost_date") >= F.lit(lo)), src, p)
              .groupBy("cost_date").agg(money(F.sum("total_cost")).alias("value"))
              .select(F.col("cost_date").alias("time"), F.lit("Actual Cost").alias("metric"), "value"))
    fc = (_forecast_ctl(src, p).where((F.col("month_start") > F.lit(p.as_of)) & (F.col("method") == p.forecast_method))
          .groupBy(F.trunc("month_start", "MM").alias("time"))
          .agg(money(F.sum("projected_cost").cast("double")).alias("value"))
          .select("time", F.lit("Linear Forecast").alias("metric"), "value"))
    return _ordered(actual.unionByName(fc), "time")



@panel("d47_forecast_by_method")
def d47(src, p):
    hi = add_months(p.as_of, 12)
    f = _forecast_ctl(src, p).where((F.col("month_start") >= F.lit(p.as_of)) & (F.col("month_start") <= F.lit(hi)))
    g = f.groupBy("month_start", "method").agg(
        money(F.sum("projected_cost").cast("double")).alias("projected_cost"),
        money(F.sum("confidence_interval_low").cast("double")).alias("low_estimate"),
        money(F.sum("confidence_interval_high").cast("double")).alias("high_estimate"))
    return g.select(rules.year_month("month_start").alias("month"), F.col("method").alias("forecast_method"),
                    "projected_cost", "low_estimate", "high_estimate")


@panel("d48_forecast_bands")
def d48(src, p):
    hi = add_months(p.as_of, 18)
    fc = (_forecast_ctl(src, p).where((F.col("month_start") >= F.lit(p.as_of)) & (F.col("month_start") <= F.lit(hi))
                                      & (F.col("method") == p.forecast_method))
          .groupBy(F.trunc("month_start", "MM").alias("time"))
          .agg(money(F.sum("projected_cost").cast("double")).alias("value"))
          .select("time", F.lit("Projected Cost").alias("metric"), "value"))
    lo = add_months(p.as_of, -6)
    monthly = (_ctl_list(src.v1.where(F.col("cost_date") >= F.lit(lo)), src, p)
               .groupBy(F.trunc("cost_date", "MM").alias("time")).agg(F.round(F.sum("total_cost"), 2).alias("_m")))
    # at most 7 monthly rows: a single ordered window partition is bounded
    w = Window.orderBy("time").rowsBetween(-2, 0)
    hist = monthly.select("time", F.lit("Historical Trend").alias("metric"), ratio(F.avg("_m").over(w)).alias("value"))
    return _ordered(fc.unionByName(hist), "time")



@panel("d49_seasonal_pattern")
def d49(src, p):
    lo = add_months(p.as_of, -24)
    m = (_ctl_list(src.v1.where(F.col("cost_date") >= F.lit(lo)), src, p)
         .groupBy(F.trunc("cost_date", "MM").alias("month"), F.month("cost_date").alias("month_num"))
         .agg(F.round(F.sum("total_cost"), 2).alias("monthly_total")))
    w = Window.partitionBy("month_num")
    return _ordered(m.select(F.col("month").alias("time"), rules.month_name_padded("month").alias("metric"),
                    ratio(F.avg("monthly_total").over(w)).alias("value")), "time")



@panel("d50_capacity_planning")
def d50(src, p):
    lo = p.as_of - dt.timedelta(days=30)
    cu = (_ctl_list(src.v2.where(F.col("usage_date") >= F.lit(lo)), src, p)
          .groupBy(F.col("capability_code").alias("license_type"))
          .agg(F.round(F.sum("total_units"), 2).alias("current_usage")))
    target = month_start(add_months(p.as_of, 12))
    caps = bounded_broadcast(src.capabilities.select("capability_id", "capability_code"), src.capabilities)
    fu = (_forecast_ctl(src, p).where(F.col("month_start") == F.lit(target))
          .join(caps, "capability_id")
          .groupBy(F.col("capability_code").alias("_code"))
          .agg(F.sum("projected_units").cast("double").alias("_f")))
    j = cu.join(fu, F.col("license_type") == F.col("_code"), "left")
    proj = F.coalesce(F.col("_f"), F.col("current_usage"))
    return j.select("license_type", "current_usage", F.round(proj, 2).alias("projected_usage_12mo"),
                    ratio(F.when(F.col("current_usage") > 0, (proj - F.col("current_usage")) / F.col("current_usage"))
                          .otherwise(F.lit(0.0))).alias("growth_rate"))
