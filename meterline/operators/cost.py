"""Pricing of usage (J01-J03, C01), account-level distribution (C10), overrides."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterline.functions.money import cents, from_cents, round_half_up_ratio
from meterline.functions.timeutil import date_lit, days_before, ts_lit
from meterline.sources.seeds import DEFAULT_UNIT_RATE
from meterline.session import bounded_broadcast

USAGE_KEY = ["ts", "app_id", "capability_id", "tier"]


def price_window_join(usage: DataFrame, prices: DataFrame, how: str = "inner") -> DataFrame:
    """Temporal price join.

    Of a small literal price list: equi keys (capability, tier) first so the effective-date range is a
    residual predicate of a broadcast hash join.  Any other price list goes by ``price_day_join``.
    """
    if not getattr(prices, "_meterline_bounded", False):
        return price_day_join(usage, prices, how)
    p = bounded_broadcast(prices.select(
        F.col("price_id"), F.col("capability_id").alias("_p_cap"), F.col("tier").alias("_p_tier"),
        "unit_rate", "start_date", "end_date"), prices)
    day = F.to_date(F.col("ts"))
    cond = ((F.col("capability_id") == F.col("_p_cap")) & (F.col("tier") == F.col("_p_tier"))
            & (day >= F.col("start_date")) & (day <= F.coalesce(F.col("end_date"), day)))
    return usage.join(p, cond, how).drop("_p_cap", "_p_tier")


def price_day_join(usage: DataFrame, prices: DataFrame, how: str = "inner") -> DataFrame:
    """J01 for a price list of any size: usage meets its price by equality on (capability, tier, day).

    Price windows are cut into months, open ones up to the last day of usage.  The days on which a capability and
    tier are used at all meet the windows of their month, so that a window is compared with at most
    31 days and never with the usage rows of a hot (capability, tier).
    """
    keys = [F.col("capability_id").alias("_p_cap"), F.col("tier").alias("_p_tier")]
    days = usage.select(*keys, F.to_date("ts").alias("_p_day")).where("_p_day is not null").distinct()
    last = days.agg(F.max("_p_day")).scalar()
    windows = (prices.select(*keys, "price_id", "unit_rate", "start_date", F.coalesce("end_date", last).alias("_end"))
                     .where(F.col("start_date") <= F.col("_end"))
                     .withColumn("_p_month", F.explode(_months("start_date", F.least(F.col("_end"), last)))))
    day_prices = (days.withColumn("_p_month", F.trunc("_p_day", "MM")).join(windows, ["_p_cap", "_p_tier", "_p_month"])
                      .where(F.col("_p_day").between(F.col("start_date"), F.col("_end")))
                      .select("_p_cap", "_p_tier", "_p_day", "price_id", "unit_rate", "start_date", F.col("_end").alias("end_date")))
    same = ((F.col("capability_id") == F.col("_p_cap")) & (F.col("tier") == F.col("_p_tier")) & (F.to_date("ts") == F.col("_p_day")))
    return usage.join(day_prices, same, how).drop("_p_cap", "_p_tier", "_p_day")


def _months(start: str, end: Column) -> Column:
    """First days of the months from ``start`` to ``end``; none if the window begins after ``end``."""
    first, last = F.trunc(start, "MM"), F.trunc(end, "MM")
    return F.when(first <= last, F.sequence(first, last, F.expr("interval 1 month"))).otherwise(F.array().cast("array<date>"))


def row_cost() -> Column:
    """Cost of one usage row: units by rate, to the cent."""
    return F.round(F.col("units_consumed") * F.col("unit_rate"), 2).cast("decimal(12,2)")


def priced_usage(usage: DataFrame, prices: DataFrame) -> DataFrame:
    """Usage rows with their cost beside them, null where no price holds."""
    return price_window_join(usage, prices, "left").withColumn("usd_cost", row_cost())


def price_overlaps(prices: DataFrame) -> DataFrame:
    """Pairs of price rows whose validity windows overlap (must be empty).

    A self-join of the bounded price list (configuration, not fact data).
    """
    a, b = prices.alias("a"), prices.alias("b")
    far = F.lit("9999-12-31").cast("date")
    return (a.join(b, (F.col("a.capability_id") == F.col("b.capability_id"))
                   & (F.col("a.tier") == F.col("b.tier"))
                   & (F.col("a.price_id") < F.col("b.price_id"))
                   & (F.col("a.start_date") <= F.coalesce(F.col("b.end_date"), far))
                   & (F.col("b.start_date") <= F.coalesce(F.col("a.end_date"), far)))
             .select(F.col("a.price_id").alias("price_id_a"), F.col("b.price_id").alias("price_id_b")))


def uncosted_usage(usage: DataFrame, cost: DataFrame | None, extra_keys: list[str] | None = None) -> DataFrame:
    """Usage rows with no cost row yet (anti-join on the full key).

    ``extra_keys`` may add columns that are functions of the key -- e.g. the ``month``
    partition column of both tables -- so the planner can prune the cost table's
    partitions dynamically instead of scanning all of it.
    """
    if cost is None:
        return usage
    keys = USAGE_KEY + list(extra_keys or [])
    return usage.join(cost.select(*keys), keys, "left_anti")


def calculate_costs(usage: DataFrame, prices: DataFrame, existing_cost: DataFrame | None = None,
                    extra_keys: list[str] | None = None) -> DataFrame:
    """Cost rows for usage not yet costed: round(units * rate, 2)."""
    todo = uncosted_usage(usage, existing_cost, extra_keys)
    priced = price_window_join(todo, prices)
    return priced.select(
        "ts", "app_id", "capability_id", "tier",
        row_cost().alias("usd_cost"),
        "price_id")


def price_as_of(prices: DataFrame, as_of) -> DataFrame:
    """One effective rate per (capability, tier) at ``as_of``.

    The reference takes an arbitrary row; we take the most recent start.
    """
    d = date_lit(as_of)
    return (prices.filter((F.col("start_date") <= d) & (d <= F.coalesce(F.col("end_date"), d)))
                  .groupBy("capability_id", "tier")
                  .agg(F.max_by("unit_rate", "start_date").alias("unit_rate")))


def with_rate_as_of(df: DataFrame, prices: DataFrame, as_of, default=DEFAULT_UNIT_RATE) -> DataFrame:
    """J02 variant: left join the rate at ``as_of``, default 0.50."""
    r = bounded_broadcast(price_as_of(prices, as_of), prices)
    return (df.join(r, ["capability_id", "tier"], "left")
              .withColumn("unit_rate", F.coalesce(F.col("unit_rate"),
                                                  F.lit(default).cast("decimal(10,4)"))))


def distribute_account_usage(account_usage: DataFrame, app_nodes: DataFrame) -> DataFrame:
    """Spread account-level units to its applications in proportion to node counts.

    account_usage: (account_id, ts, capability_code, tier, units)
    app_nodes:     (account_id, app_id, node_count)
    Per-account node totals are a grouped aggregate joined back (no window
    over one hot account), then the account rows are joined on account_id.
    """
    totals = app_nodes.groupBy("account_id").agg(F.sum("node_count").alias("_nodes_total"))
    shares = (app_nodes.join(totals, "account_id")
                       .where(F.col("_nodes_total") > 0)
                       .select("account_id", "app_id", "node_count", "_nodes_total"))
    # exact: units (in cents) x nodes / total, rounded half-up to the cent
    amount = round_half_up_ratio(cents(F.col("units")) * F.col("node_count"), F.col("_nodes_total"))
    return (account_usage.join(shares, "account_id")
                         .select("ts", "app_id", "capability_code", "tier",
                                 from_cents(amount).alias("units_consumed"),
                                 F.col("node_count").cast("int").alias("nodes_count")))


OVERRIDE_FIELDS = ("h_code", "owner", "sector", "architecture")


def apply_overrides(app: DataFrame, overrides: DataFrame, as_of) -> DataFrame:
    """Active, unexpired manual overrides win over the base attribute.

    overrides: (app_id, field_name, override_value, is_active, expires_at, created_at)
    Newest override per (app, field) wins; the result has one row per app.
    """
    t = ts_lit(days_before(as_of, 0))
    live = overrides.where(F.col("is_active") & (F.col("expires_at").isNull() | (F.col("expires_at") > t)))
    newest = (live.groupBy("app_id")
                  .agg(*[F.max_by(F.when(F.col("field_name") == f, F.col("override_value")),
                                  F.when(F.col("field_name") == f, F.col("created_at"))).alias(f"_ov_{f}")
                         for f in OVERRIDE_FIELDS]))
    out = app.join(newest, "app_id", "left")
    out = (out.withColumn("h_code", F.coalesce(F.col("_ov_h_code"), F.col("h_code")))
              .withColumn("owner_id", F.coalesce(F.col("_ov_owner").try_cast("int"), F.col("owner_id")))
              .withColumn("sector_id", F.coalesce(F.col("_ov_sector").try_cast("int"), F.col("sector_id")))
              .withColumn("architecture_id",
                          F.coalesce(F.col("_ov_architecture").try_cast("int"), F.col("architecture_id"))))
    return out.drop(*[f"_ov_{f}" for f in OVERRIDE_FIELDS])
