"""Pre-aggregated reporting tables V1-V8.

Each view first aggregates the fact to (day|month, app, ...) -- a partial
aggregate that shrinks the input of the dimension join -- and only then
joins the application dimension and rolls up to the view grain. Because the
pre-aggregate is unique per app within a view group, COUNT(DISTINCT app) is
a plain count of pre-aggregated rows (no Expand / double aggregation).
Grouping uses raw dimension columns and the output coalesces them, so a
NULL and a literal 'Unknown' stay two rows (as in the reference).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from meterline.functions.timeutil import since, days_before, month_start, months_before, ts_lit, add_months, as_date, date_lit
from meterline.session import bounded_broadcast


def _dbl(c):
    return F.col(c).cast("double") if isinstance(c, str) else c.cast("double")


def _avg(sum_col: str, cnt_col: str):
    return F.try_divide(_dbl(sum_col), F.col(cnt_col))


def _unknown(c: str):
    return F.coalesce(F.col(c), F.lit("Unknown"))


def _daily_cost_by_app(cost: DataFrame, as_of, days: int) -> DataFrame:
    return (since(cost, days_before(as_of, days))
                .groupBy(F.to_date("ts").alias("cost_date"), "app_id", "tier")
                .agg(F.sum("usd_cost").alias("_s"), F.count("usd_cost").alias("_c"),
                     F.count(F.lit(1)).alias("_n")))


#: log2 of the registers of a distinct-count sketch, and its relative standard error: 1.04 / sqrt(2^14)
SKETCH_K = 14
SKETCH_ERROR = 1.04 / 2 ** (SKETCH_K / 2)


def v1_daily_cost_by_controller(cost: DataFrame, app: DataFrame, as_of, days: int = 180, sketches: bool = False) -> DataFrame:
    """V1; with ``sketches`` also ``app_sketch``, which ``apps_of`` merges over any rows of the view."""
    pre = _daily_cost_by_app(cost, as_of, days).join(app.select("app_id", "controller"), "app_id")
    g = (pre.groupBy("cost_date", "controller", "tier")
            .agg(F.sum("_s").alias("_s"), F.sum("_c").alias("_c"), F.sum("_n").alias("_n"),
                 F.count(F.lit(1)).alias("_apps"), *_sketch(sketches)))
    return g.select("cost_date", _unknown("controller").alias("controller"), "tier",
                    _dbl("_s").alias("total_cost"), _avg("_s", "_c").alias("avg_cost"),
                    F.col("_n").cast("bigint").alias("record_count"),
                    F.col("_apps").cast("bigint").alias("app_count"), *(["app_sketch"] if sketches else []))


def _sketch(wanted: bool) -> list:
    return [F.hll_sketch_agg("app_id", SKETCH_K).alias("app_sketch")] if wanted else []


def apps_of(view: DataFrame, *by) -> DataFrame:
    """Different applications in each group of a view's rows, from its sketches: no fact is read again.

    A count of distinct applications cannot be added up from ``app_count``; sketches can be merged, with a relative
    standard error of ``SKETCH_ERROR`` (0.8 %) whatever the number of rows merged.
    """
    return view.groupBy(*by).agg(F.hll_sketch_estimate(F.hll_union_agg("app_sketch")).alias("apps"))


def v2_daily_usage_by_capability(usage: DataFrame, app: DataFrame, capabilities: DataFrame,
                                 as_of, days: int = 180, sketches: bool = False) -> DataFrame:
    pre = (since(usage, days_before(as_of, days))
                .groupBy(F.to_date("ts").alias("usage_date"), "app_id", "capability_id", "tier")
                .agg(F.sum("units_consumed").alias("_u"), F.count("units_consumed").alias("_uc"),
                     F.sum("nodes_count").alias("_nd"), F.count("nodes_count").alias("_ndc"),
                     F.count(F.lit(1)).alias("_n")))
    caps = bounded_broadcast(capabilities.select("capability_id", "capability_code", "capability_name"), capabilities)
    j = pre.join(caps, "capability_id").join(app.select("app_id", "controller"), "app_id")
    g = (j.groupBy("usage_date", "capability_code", "capability_name", "controller", "tier")
          .agg(*[F.sum(c).alias(c) for c in ("_u", "_uc", "_nd", "_ndc", "_n")],
               F.count(F.lit(1)).alias("_apps"), *_sketch(sketches)))
    return g.select("usage_date", "capability_code", "capability_name",
                    _unknown("controller").alias("controller"), "tier",
                    _dbl("_u").alias("total_units"), _avg("_u", "_uc").alias("avg_units"),
                    F.col("_nd").cast("bigint").alias("total_nodes"), _avg("_nd", "_ndc").alias("avg_nodes"),
                    F.col("_apps").cast("bigint").alias("app_count"),
                    F.col("_n").cast("bigint").alias("record_count"), *(["app_sketch"] if sketches else []))


def _cost_by_attr(cost, app, as_of, days, dim, dim_key, dim_name, out_name):
    pre = (_daily_cost_by_app(cost, as_of, days)
           .join(app.select("app_id", "controller", dim_key), "app_id")
           .join(bounded_broadcast(dim.select(F.col(dim_key).alias("_dk"), F.col(dim_name).alias("_dn")), dim),
                 F.col(dim_key) == F.col("_dk"), "left"))
    g = (pre.groupBy("cost_date", "_dn", "_dk", "controller", "tier")
            .agg(F.sum("_s").alias("_s"), F.sum("_c").alias("_c"), F.sum("_n").alias("_n"),
                 F.count(F.lit(1)).alias("_apps")))
    return g.select("cost_date", F.coalesce(F.col("_dn"), F.lit("Unknown")).alias(out_name),
                    F.col("_dk").alias(dim_key), _unknown("controller").alias("controller"), "tier",
                    _dbl("_s").alias("total_cost"), _avg("_s", "_c").alias("avg_cost"),
                    F.col("_apps").cast("bigint").alias("app_count"),
                    F.col("_n").cast("bigint").alias("record_count"))


def v3_cost_by_sector_controller(cost, app, sectors, as_of, days: int = 180) -> DataFrame:
    return _cost_by_attr(cost, app, as_of, days, sectors, "sector_id", "sector_name", "sector_name")


def v4_cost_by_owner_controller(cost, app, owners, as_of, days: int = 180) -> DataFrame:
    return _cost_by_attr(cost, app, as_of, days, owners, "owner_id", "owner_name", "owner_name")


def _v5_finish(j: DataFrame, app: DataFrame, architectures: DataFrame, capabilities: DataFrame) -> DataFrame:
    """Group (arch, controller, capability, cost tier) from per-(app, ...) partial sums."""
    arch = bounded_broadcast(architectures.select(F.col("architecture_id").alias("_ak"),
                                            F.col("pattern_name").alias("_an")), architectures)
    caps = bounded_broadcast(capabilities.select("capability_id", "capability_code", "capability_name"), capabilities)
    a = app.select("app_id", "controller", "architecture_id")
    x = (j.join(a, "app_id")
          .join(arch, F.col("architecture_id") == F.col("_ak"), "left")
          .join(caps, "capability_id", "left"))
    keys = ["_an", "_ak", "controller", "capability_code", "capability_name", "ctier"]
    sums = ("su", "cu", "sn", "cn", "sc", "cc")
    # two-step: per app first (distinct apps = rows of the second step)
    per_app = x.groupBy(*keys, "app_id").agg(*[F.sum(c).alias(c) for c in sums])
    g = per_app.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in sums], F.count(F.lit(1)).alias("apps"))
    avg_nodes = _avg("sn", "cn")
    return g.select(
        F.coalesce(F.col("_an"), F.lit("Unknown")).alias("architecture_name"),
        F.col("_ak").alias("architecture_id"),
        _unknown("controller").alias("controller"), "capability_code", "capability_name",
        F.col("ctier").alias("tier"),
        F.col("apps").cast("bigint").alias("app_count"),
        _dbl("su").alias("total_units"), _avg("su", "cu").alias("avg_units_per_day"),
        F.col("sn").cast("bigint").alias("total_nodes"), avg_nodes.alias("avg_nodes"),
        _dbl("sc").alias("total_cost"), _avg("sc", "cc").alias("avg_cost_per_day"),
        F.when(avg_nodes > 0, _dbl("su") / avg_nodes).otherwise(F.lit(0.0)).alias("units_per_node"),
        F.when(avg_nodes > 0, _dbl("sc") / avg_nodes).otherwise(F.lit(0.0)).alias("cost_per_node"),
    )


def v5_architecture_metrics(usage, cost, app, architectures, capabilities, as_of, days: int = 90) -> DataFrame:
    """Literal V5: usage joined to cost on (app, day) only (R7 fan-out kept).

    The product is never materialised: each side is pre-aggregated per
    (app, day, own group column) and the fan-out enters the sums as
    multiplicities (units x cost-row count, cost x usage-row count).
    A usage group with no cost row counts once with a NULL tier.
    """
    t0 = days_before(as_of, days)
    u = (since(usage, t0)
              .groupBy("app_id", F.to_date("ts").alias("d"), "capability_id")
              .agg(F.sum("units_consumed").alias("u_s"), F.count("units_consumed").alias("u_c"),
                   F.sum("nodes_count").alias("n_s"), F.count("nodes_count").alias("n_c"),
                   F.count(F.lit(1)).alias("u_rows")))
    c = (since(cost, t0)
             .groupBy("app_id", F.to_date("ts").alias("d"), F.col("tier").alias("ctier"))
             .agg(F.sum("usd_cost").alias("c_s"), F.count("usd_cost").alias("c_c"),
                  F.count(F.lit(1)).alias("c_rows")))
    j = u.join(c, ["app_id", "d"], "left")
    mult = F.coalesce(F.col("c_rows"), F.lit(1))
    j = j.select("app_id", "capability_id", "ctier",
                 (F.col("u_s") * mult).alias("su"), (F.col("u_c") * mult).alias("cu"),
                 (F.col("n_s") * mult).alias("sn"), (F.col("n_c") * mult).alias("cn"),
                 (F.col("c_s") * F.col("u_rows")).alias("sc"),
                 F.coalesce(F.col("c_c") * F.col("u_rows"), F.lit(0)).alias("cc"))
    return _v5_finish(j, app, architectures, capabilities)


def v5_architecture_metrics_exact(usage, cost, app, architectures, capabilities, as_of,
                                  days: int = 90) -> DataFrame:
    """V5 at the exact grain: usage joined to cost on (ts, app, capability, tier)."""
    t0 = days_before(as_of, days)
    u = since(usage, t0)
    c = (since(cost, t0)
             .select("ts", "app_id", "capability_id", F.col("tier").alias("ctier"), "usd_cost"))
    j = u.join(c, (u.ts == c.ts) & (u.app_id == c.app_id) & (u.capability_id == c.capability_id)
               & (u.tier == c.ctier), "left")
    j = j.select(u.app_id, u.capability_id, "ctier",
                 F.col("units_consumed").alias("su"),
                 F.col("units_consumed").isNotNull().cast("long").alias("cu"),
                 F.col("nodes_count").cast("long").alias("sn"),
                 F.col("nodes_count").isNotNull().cast("long").alias("cn"),
                 F.col("usd_cost").alias("sc"), F.col("usd_cost").isNotNull().cast("long").alias("cc"))
    return _v5_finish(j, app, architectures, capabilities)


def _band(c):
    """Integer that never falls as ``c`` grows: 64 bands to each doubling of the amount; null is highest."""
    x = c.cast("double")
    wide = F.floor(F.log2(F.abs(x)) * 64)
    return (F.when(x.isNull(), F.lit(1 << 20)).when(x > 0, wide).when(x == 0, F.lit(-(1 << 20)))
             .otherwise(-(1 << 21) - wide))


def v6_app_cost_rankings_monthly(cost, app, sectors, owners, as_of, months: int = 13) -> DataFrame:
    pre = (since(cost, months_before(as_of, months))
               .groupBy(F.trunc("ts", "MM").alias("month_start"), "app_id", F.col("tier").alias("cost_tier"))
               .agg(F.sum("usd_cost").alias("_s"), F.count("usd_cost").alias("_c"),
                    F.count(F.lit(1)).alias("_n")))
    a = app.where(F.col("app_name").isNotNull()).select(
        "app_id", "app_name", "monitoring_id", "controller", "sector_id", "owner_id", "license_tier")
    s = bounded_broadcast(sectors.select(F.col("sector_id").alias("_sk"), "sector_name"), sectors)
    o = bounded_broadcast(owners.select(F.col("owner_id").alias("_ok"), "owner_name"), owners)
    j = (pre.join(a, "app_id")
            .join(s, F.col("sector_id") == F.col("_sk"), "left")
            .join(o, F.col("owner_id") == F.col("_ok"), "left"))
    # a band holds about 1 % of the value range, so no task sorts a whole controller-month;
    # the rows above a band are counted in a table of some thousand bands per controller-month
    j = j.withColumn("_band", _band(F.col("_s")))
    band = ["month_start", "controller", "_band"]
    above = Window.partitionBy("month_start", "controller").orderBy(F.col("_band").desc()).rowsBetween(
        Window.unboundedPreceding, -1)
    bands = (j.groupBy(*band).agg(F.count(F.lit(1)).alias("_in"))
              .withColumn("_above", F.coalesce(F.sum("_in").over(above), F.lit(0)))
              .select(*[F.col(c).alias(f"{c}_b") for c in band], "_above"))
    j = j.join(bands, reduce(lambda x, y: x & y, [F.col(c).eqNullSafe(F.col(f"{c}_b")) for c in band]))
    w = Window.partitionBy(*band).orderBy(F.col("_s").desc_nulls_first())
    return j.select(
        "month_start", "app_id", "app_name", "monitoring_id",
        _unknown("controller").alias("controller"), _unknown("sector_name").alias("sector_name"),
        _unknown("owner_name").alias("owner_name"), "license_tier", "cost_tier",
        _dbl("_s").alias("total_cost"), _avg("_s", "_c").alias("avg_daily_cost"),
        F.col("_n").cast("bigint").alias("days_active"),
        (F.col("_above") + F.rank().over(w)).cast("bigint").alias("cost_rank"))


def v7_monthly_chargeback_summary(chargeback, app, sectors, as_of, months: int = 24) -> DataFrame:
    lo = month_start(add_months(as_date(as_of), -months))
    c = chargeback.where(F.col("month_start") >= date_lit(lo))
    s = bounded_broadcast(sectors.select(F.col("sector_id").alias("_sk"), "sector_name"), sectors)
    j = (c.join(app.select("app_id", "controller"), "app_id")
          .join(s, F.col("sector_id") == F.col("_sk"), "left"))
    g = (j.groupBy("month_start", "controller", "sector_name", "_sk", "h_code")
          .agg(F.sum("usd_amount").alias("_s"), F.count("usd_amount").alias("_c"),
               F.countDistinct("app_id").alias("_apps"), F.count(F.lit(1)).alias("_n")))
    return g.select("month_start", _unknown("controller").alias("controller"),
                    _unknown("sector_name").alias("sector_name"), F.col("_sk").alias("sector_id"),
                    _unknown("h_code").alias("h_code"),
                    _dbl("_s").alias("total_amount"), _avg("_s", "_c").alias("avg_amount"),
                    F.col("_apps").cast("bigint").alias("app_count"),
                    F.col("_n").cast("bigint").alias("chargeback_records"))


def v8_peak_pro_comparison(cost, app, as_of, days: int = 90) -> DataFrame:
    """Peak vs Pro per (day, app) in one pass (equivalent to the full outer join)."""
    c = (cost.where((F.col("ts") >= ts_lit(days_before(as_of, days))) & F.col("tier").isin("Peak", "Pro"))
             .groupBy(F.to_date("ts").alias("cost_date"), "app_id")
             .agg(F.sum(F.when(F.col("tier") == "Peak", F.col("usd_cost"))).alias("_pk"),
                  F.sum(F.when(F.col("tier") == "Pro", F.col("usd_cost"))).alias("_pr")))
    j = c.join(app.select("app_id", "app_name", "controller"), "app_id")
    pk = F.coalesce(F.col("_pk"), F.lit(0))
    pr = F.coalesce(F.col("_pr"), F.lit(0))
    return j.select(
        "cost_date", "app_id", "app_name", "controller",
        pk.cast("double").alias("peak_cost"), pr.cast("double").alias("pro_cost"),
        (pk + pr).cast("double").alias("total_cost"),
        F.when(F.col("_pk") > 0, F.col("_pk") - F.col("_pk") * F.lit(0.67).cast("decimal(3,2)"))
         .otherwise(F.lit(0)).cast("double").alias("potential_savings"))
