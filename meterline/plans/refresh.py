"""Incremental upkeep of what is derived from the facts: views V1-V8 (V9) and checks Q04, Q07, Q15.

The facts are versioned tables partitioned by month (``sources.versions``); a month's stamp
changes exactly when its rows do.  Every derived table is partitioned by month as well
and keeps, in the same manifest as its rows, the stamps it was made from.  A refresh compares
stamps, reads only the months that changed, and replaces only these months of the derived table.
All months are made again when the dimensions changed (one digest over their rows).
"""

from __future__ import annotations

import datetime as dt
import time
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterline.functions.timeutil import add_months, as_date, days_before, month_start, months_before
from meterline.operators import views as V
from meterline.plans import quality as Q
from meterline.sources.star import Star
from meterline.sources.versions import NULL_PARTITION, Table

MONTH = "refresh_month"


class Facts:
    """The stored facts of a root folder, and stars over some months of them."""

    TABLES = {"usage": ("license_usage_fact", "month"), "cost": ("license_cost_fact", "month"),
              "chargeback": ("chargeback_fact", "month_start")}

    def __init__(self, base: Star, root: str):
        self.base, self.root = base, root.rstrip("/")
        self.tables = {n: Table(base.spark, f"{self.root}/{folder}", by, ["app_id"]) for n, (folder, by) in self.TABLES.items()}

    def stamps(self, names) -> dict[str, dict[str, list[str]]]:
        return {n: self.tables[n].stamps() for n in names}

    def star(self, months: list | None = None) -> "StoredStar":
        return StoredStar(self, months)


class StoredStar(Star):
    """A star whose facts are months (None: all) of the stored tables."""

    def __init__(self, facts: Facts, months: list | None = None):
        base = facts.base
        super().__init__(base.spark, base.sf_dir, base.as_of, base.source)
        self.facts = facts
        for name, table in facts.tables.items():
            if table.exists():
                self.__dict__["chargeback_all" if name == "chargeback" else name] = table.read(months)
        if "chargeback_all" in self.__dict__:
            self.__dict__["chargeback"] = self.chargeback_all.where(F.col("chargeback_cycle") == "direct")

    def chargeback_from(self, month, until=None) -> DataFrame:
        return self._months(self.chargeback, month, until)

    def chargeback_all_from(self, month, until=None) -> DataFrame:
        return self._months(self.chargeback_all, month, until)

    def newest_chargeback(self) -> DataFrame:
        """Direct chargeback of the newest month, found by the partitions' names."""
        table = self.facts.tables["chargeback"]
        months = [m for m in table.stamps() if m != NULL_PARTITION]
        return table.read(sorted(months)[-1:]).where(F.col("chargeback_cycle") == "direct")

    @staticmethod
    def _months(table: DataFrame, month, until) -> DataFrame:
        table = table.where(F.col("month_start") >= F.lit(month))
        return table if until is None else table.where(F.col("month_start") < F.lit(until))


# --- views ----------------------------------------------------------------------------------------

@dataclass(frozen=True)
class View:
    """A view, the facts it reads, the day column its months come from (None: one row set of the whole
    window), and the first day of its window."""
    build: Callable[[Star], DataFrame]
    facts: tuple[str, ...]
    day: str | None
    start: Callable[[dt.date], dt.date]


def _days(n):
    return lambda as_of: days_before(as_of, n).date()


VIEWS: dict[str, View] = {
    "v1": View(lambda s: V.v1_daily_cost_by_controller(s.cost, s.app, s.as_of), ("cost",), "cost_date", _days(180)),
    "v2": View(lambda s: V.v2_daily_usage_by_capability(s.usage, s.app, s.capabilities, s.as_of), ("usage",), "usage_date", _days(180)),
    "v3": View(lambda s: V.v3_cost_by_sector_controller(s.cost, s.app, s.sectors, s.as_of), ("cost",), "cost_date", _days(180)),
    "v4": View(lambda s: V.v4_cost_by_owner_controller(s.cost, s.app, s.owners, s.as_of), ("cost",), "cost_date", _days(180)),
    "v5": View(lambda s: V.v5_architecture_metrics(s.usage, s.cost, s.app, s.architectures, s.capabilities, s.as_of),
               ("usage", "cost"), None, _days(90)),
    "v6": View(lambda s: V.v6_app_cost_rankings_monthly(s.cost, s.app, s.sectors, s.owners, s.as_of), ("cost",), "month_start",
               lambda as_of: months_before(as_of, 13).date()),
    "v7": View(lambda s: V.v7_monthly_chargeback_summary(s.chargeback, s.app, s.sectors, s.as_of), ("chargeback",), "month_start",
               lambda as_of: month_start(add_months(as_date(as_of), -24))),
    "v8": View(lambda s: V.v8_peak_pro_comparison(s.cost, s.app, s.as_of), ("cost",), "cost_date", _days(90)),
}


def digest(*frames: DataFrame) -> str:
    """One value of all rows of small frames, whatever their order: two jobs' frames are equal if theirs are."""
    return "/".join(str(df.agg(F.count("*").alias("n"), F.sum(F.xxhash64(*df.columns).cast("decimal(38,0)")).alias("h")).first())
                    for df in frames)


def month_of(name: str) -> dt.date:
    return dt.date.fromisoformat(name)


def changed_months(old: dict | None, now: dict, start: dt.date, whole: bool, moved: bool) -> list[dt.date]:
    """Months from ``start`` on to make again, by the stamps noted in ``old`` and those of ``now``.

    ``whole``: all months; ``moved``: the window's start has moved, so its first month is cut elsewhere.
    """
    first, old = month_start(start), old or {}
    months = {m for stamps in (*old.values(), *now.values()) for m in stamps if m != NULL_PARTITION and month_of(m) >= first}
    return sorted(month_of(m) for m in months if whole or (moved and month_of(m) == first)
                  or any(old.get(f, {}).get(m) != now[f].get(m) for f in now))


def refresh_view(name: str, facts: Facts, dims: str) -> tuple[str, list[dt.date]]:
    """Bring one published view up to date: (what was done, months made)."""
    view, spark, as_of = VIEWS[name], facts.base.spark, as_date(facts.base.as_of)
    table = view_table(spark, facts.root, name)
    last = table.manifest()
    notes = {} if last is None else last.notes
    now = facts.stamps(view.facts)
    start = view.start(as_of)
    whole = last is None or notes.get("dims") != dims or (view.day is None and notes.get("as_of") != str(as_of))
    again = changed_months(notes.get("stamps"), now, start, whole, notes.get("as_of") not in (None, str(as_of)))
    gone = [] if last is None or view.day is None else [month_of(m) for m in last.parts if month_of(m) < month_start(start)]
    if not again and not gone and last is not None:
        return "unchanged", []
    if view.day is None:                             # an aggregate of the window: made from its months, as one partition
        again = changed_months(None, now, start, True, False)
        parts = None
    else:
        parts = None if last is None else [*again, *gone]
    rows = view.build(facts.star(again))
    key = F.lit(as_of).cast("date") if view.day is None else F.trunc(F.col(view.day), "MM")
    table.replace(rows.withColumn(MONTH, key), parts, {"stamps": now, "dims": dims, "as_of": str(as_of)}, last)
    return ("full" if whole else "incremental"), again


def view_table(spark: SparkSession, root: str, name: str) -> Table:
    return Table(spark, f"{root.rstrip('/')}/views/{name}", MONTH)


def published(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """The current version of every view."""
    tables = {n: view_table(spark, root, n) for n in VIEWS}
    return {n: t.read().drop(MONTH) for n, t in tables.items() if t.exists()}


STATUS = "view string, status string, mode string, months int, rows_before long, rows long, seconds double, error string"


def refresh_views(facts: Facts, names=tuple(VIEWS)) -> DataFrame:
    """V9: bring the views up to date; one failure does not stop the others, whose readers keep the last version."""
    spark, base = facts.base.spark, facts.base
    dims = digest(base.app, base.sectors, base.owners, base.architectures, base.capabilities)
    status = []
    for name in names:
        t0 = time.perf_counter()
        table = view_table(spark, facts.root, name)
        before = table.read().count() if table.exists() else 0
        try:
            mode, months = refresh_view(name, facts, dims)
            rows = before if mode == "unchanged" else table.read().count()
            status.append((name, "success", mode, len(months), before, rows, round(time.perf_counter() - t0, 3), None))
        except Exception as e:  # noqa: BLE001 - report and carry on
            status.append((name, "failed", None, 0, before, None, round(time.perf_counter() - t0, 3), str(e)[:500]))
    return spark.createDataFrame(status, STATUS)


# --- checks ---------------------------------------------------------------------------------------

CHECKS = "refresh_month date, day date, check_name string, value decimal(38,6)"


def month_checks(star: Star) -> DataFrame:
    """Per day, what Q04, Q07 and Q15 count or sum in the star's months: (month, day, check, value).

    Every key that is checked holds the timestamp, so a month can be checked by itself.
    """
    from meterline.operators.cost import price_window_join
    day = F.to_date("ts")

    def shape(df: DataFrame) -> DataFrame:
        return df.select(F.trunc("day", "MM").alias(MONTH), "day", F.inline(F.array(*[
            F.struct(F.lit(c).alias("check_name"), F.col(c).cast("decimal(38,6)").alias("value")) for c in df.columns if c != "day"])))

    usage, cost = star.usage, star.cost
    orphans = usage.join(cost.select("ts", "app_id", "capability_id"), ["ts", "app_id", "capability_id"], "left_anti")
    both = usage.select("ts", "app_id", "capability_id", "tier", "units_consumed").join(
        cost.select("ts", "app_id", "capability_id", "tier", "usd_cost"), ["ts", "app_id", "capability_id", "tier"])
    priced = price_window_join(both, star.price)
    parts = [shape(orphans.groupBy(day.alias("day")).agg(F.count("*").alias("orphan_rows"))),
             shape(priced.groupBy(day.alias("day")).agg(F.sum(F.col("units_consumed") * F.col("unit_rate")).alias("expected_cost"),
                                                        F.sum("usd_cost").alias("actual_cost")))]
    for name, fact in (("usage", usage), ("cost", cost)):
        keys = ["ts", "app_id", "capability_id", "tier"]
        rule = Q.CONSTRAINTS[name]
        full = reduce(lambda x, y: x & y, [F.col(k).isNotNull() for k in keys])
        again = fact.where(full).groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")
        parts.append(shape(again.groupBy(day.alias("day")).agg(F.sum(F.col("n") - 1).alias(f"{name}_{'_'.join(keys)}_unique"))))
        known = star.app.select(F.col("app_id").alias("_k"), F.lit(True).alias("_has"))
        flagged = fact.join(known, F.col("app_id") == F.col("_k"), "left")
        checks = {f"{name}_{c}_not_null": F.col(c).isNull() for c in rule["required"]}
        checks |= {f"{name}_{c}_values": F.col(c).isNotNull() & ~F.col(c).isin(*v) for c, v in rule["values"].items()}
        checks[f"{name}_app_id_fk"] = F.col("app_id").isNotNull() & F.col("_has").isNull()
        parts.append(shape(flagged.groupBy(day.alias("day")).agg(*[F.count_if(e).alias(n) for n, e in checks.items()])))
    return reduce(DataFrame.unionByName, parts)


class StoredChecks:
    """The checks' results by day, kept beside the facts and brought up to date by changed months."""

    def __init__(self, facts: Facts):
        self.facts, self.table = facts, Table(facts.base.spark, f"{facts.root}/check_results", MONTH)

    def refresh(self) -> list[dt.date]:
        """Check the months that changed (all, if the applications did); returns them."""
        last = self.table.manifest()
        notes = {} if last is None else last.notes
        now, dims = self.facts.stamps(("usage", "cost")), digest(self.facts.base.app, self.facts.base.price)
        again = changed_months(notes.get("stamps"), now, dt.date(1, 1, 1), notes.get("dims") != dims, False)
        if again:
            self.table.replace(month_checks(self.facts.star(again)), None if last is None else again, {"stamps": now, "dims": dims}, last)
        return again

    def _since(self, days: int) -> DataFrame:
        first = days_before(self.facts.base.as_of, days).date()
        return self.table.read().where((F.col(MONTH) >= F.lit(month_start(first))) & (F.col("day") >= F.lit(first)))

    def orphan_usage(self, days: int = 90) -> DataFrame:
        """Q04 from the kept results."""
        n = F.coalesce(F.sum(F.when(F.col("check_name") == "orphan_rows", F.col("value"))), F.lit(0)).cast("long")
        return self._since(days).agg(n.alias("orphan_rows")).withColumn("ok", F.col("orphan_rows") <= Q.MAX_ORPHAN_ROWS)

    def cost_variance(self, days: int = 30) -> DataFrame:
        """Q07 from the kept results."""
        def total(c):
            return F.sum(F.when(F.col("check_name") == c, F.col("value")))
        g = self._since(days).agg(total("expected_cost").alias("_exp"), total("actual_cost").alias("_act"))
        var = F.round(F.abs(F.col("_act") - F.col("_exp")).cast("double") * 100 / F.col("_exp").cast("double"), 6)
        return g.select(F.col("_exp").cast("double").alias("expected_cost"), F.col("_act").cast("double").alias("actual_cost"),
                        var.alias("variance_pct"), F.coalesce(var < Q.MAX_COST_VARIANCE_PCT, F.lit(False)).alias("ok"))

    def violations(self) -> DataFrame:
        """Q15 of usage and cost from the kept results; a check without a row has none."""
        skip = ("orphan_rows", "expected_cost", "actual_cost")
        return (self.table.read().where(~F.col("check_name").isin(*skip)).groupBy("check_name")
                .agg(F.sum("value").cast("long").alias("violations")).withColumn("ok", F.col("violations") == 0))


