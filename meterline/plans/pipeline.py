"""The batch pipeline: materialise the facts once, then derive everything from them.

Steps (each a Spark job; statuses come back as a small DataFrame):
  usage      usage fact -> versioned table partitioned by ``month``
  cost       C01 on the usage not yet costed (anti-join), appended to open months only
  chargeback C03: the ``direct`` cycle of the touched months is replaced
  allocation C06-C09: the ``allocated...`` cycles of the touched months are replaced (R4 ruling)
  forecast   F06 ensemble forecast (events star) -> versioned table
  views      V1-V8 brought up to date from the changed months (V9)
  checks     Q01 / Q04 / Q07 / Q15 results, Q04, Q07 and the facts' Q15 by changed months
Tables (``sources.versions``) live under ``root``, a folder that all executors share; each write becomes
visible by one atomic change, so a failure at any step leaves every table as it was or as it was to be.
Re-running is idempotent: usage and cost insert only missing keys, postings replace, and months without
new usage or cost are not computed again.  A changed rule or application dimension is applied to the
months given as ``months``.  Every step is written to the run log ``root/run_log``; a lease keeps
a second run from starting meanwhile.
"""

from __future__ import annotations

import datetime as dt
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterline.functions.timeutil import PARTITION_COL
from meterline.operators.allocation import CYCLE_BY_METHOD, allocate_shared_costs
from meterline.operators.chargeback import direct_chargeback
from meterline.operators.cost import USAGE_KEY, calculate_costs, price_overlaps
from meterline.plans import quality as Q
from meterline.plans.refresh import Facts, StoredChecks, StoredStar, published, refresh_views
from meterline.sources import seeds
from meterline.sources.runlog import RunLog
from meterline.sources.star import Star
from meterline.sources.versions import NULL_PARTITION, Table


def _with_month(df: DataFrame) -> DataFrame:
    return df.withColumn(PARTITION_COL, F.trunc("ts", "MM"))


class TableStar(StoredStar):
    """A Star whose facts are read back from the pipeline's tables, and its views, if
    ``use_published``, from their current published versions."""

    def __init__(self, base: Star, root: str, use_published: bool = True):
        super().__init__(Facts(base, root))
        if use_published:
            self.__dict__.update(published(base.spark, root))


def run_pipeline(spark: SparkSession, sf_dir: str, root: str, months: list | None = None,
                 rules: DataFrame | None = None) -> DataFrame:
    """Run all steps; ``months`` (first days) are posted again besides those with new usage or cost."""
    root = root.rstrip("/")
    base = Star(spark, sf_dir)
    rules = seeds.allocation_rules(spark) if rules is None else rules
    log = RunLog(spark, f"{root}/run_log")
    status: list[tuple] = []
    touched: set = set(months or [])

    def step(name, fn):
        t0 = time.perf_counter()
        run = log.start(name)
        try:
            info = fn()
            log.end(run, "success", metadata={"info": str(info)} if info else None)
            status.append((name, "success", round(time.perf_counter() - t0, 3), str(info) if info else None))
        except Exception as e:  # noqa: BLE001 - recorded, then raised
            log.end(run, "failed", error=str(e)[:500])
            status.append((name, "failed", round(time.perf_counter() - t0, 3), str(e)[:500]))
            raise

    facts = Facts(base, root)
    usage_table, cost_table, posted = (facts.tables[n] for n in ("usage", "cost", "chargeback"))
    forecast_table = Table(spark, f"{root}/forecast_fact", "month_start", ["app_id"])

    def append(rows, table):
        """Append to a fact and remember the months that got rows."""
        touched.update(dt.date.fromisoformat(m) for m in table.append(rows) if m != NULL_PARTITION)

    def usage_step():
        # S07a insert-if-absent: only usage keys not loaded yet are appended
        fresh = _with_month(base.usage)
        if usage_table.exists():
            # null-safe key equality: a reload must not re-append rows whose key has a NULL part
            keys = USAGE_KEY + [PARTITION_COL]
            old = usage_table.read().select(*[F.col(k).alias(f"_o_{k}") for k in keys])
            cond = None
            for k in keys:
                e = F.col(k).eqNullSafe(F.col(f"_o_{k}"))
                cond = e if cond is None else cond & e
            fresh = fresh.join(old, cond, "left_anti")
        append(fresh, usage_table)

    def cost_step():
        overlaps = price_overlaps(base.price).count()
        if overlaps:
            raise RuntimeError(f"{overlaps} overlapping price windows: usage would be costed twice")
        existing = cost_table.read() if cost_table.exists() else None
        new = calculate_costs(usage_table.read(), base.price, existing, extra_keys=[PARTITION_COL])
        append(_with_month(new), cost_table)

    def post(rows, cycles):
        """C09 (R4): in the touched months the rows of ``cycles`` become exactly ``rows``; other cycles stay."""
        def slices(old):
            return old.where(~F.coalesce(F.col("chargeback_cycle").isin(*cycles), F.lit(False))).unionByName(rows.select(*old.columns))
        if posted.exists():
            posted.rewrite(touched, slices)
        else:
            posted.append(rows)

    def chargeback_step():
        if touched:
            post(direct_chargeback(cost_table.read(touched), base.app), ["direct"])
        return {"months": len(touched)}

    def allocation_step():
        if touched:
            post(allocate_shared_costs(cost_table.read(touched), usage_table.read(touched), base.app, base.sectors, rules),
                 sorted(CYCLE_BY_METHOD.values()))
        return {"months": len(touched)}

    ev = Star.events(spark, sf_dir)

    def forecast_step():
        forecast_table.replace(ev.forecast)

    def views_step():
        st = refresh_views(facts).collect()
        failed = [r.view for r in st if r.status != "success"]
        if failed:
            raise RuntimeError(f"views failed: {failed}")
        return {r.view: (r.mode, r.rows_before, r.rows) for r in st}

    def checks_step():
        ts = TableStar(base, root)
        kept = StoredChecks(facts)
        months = kept.refresh()
        q1 = Q.row_counts({"license_usage": ts.usage, "license_cost": ts.cost, "chargeback": ts.chargeback_all})
        q15 = Q.constraint_checks({"app": ts.app, "chargeback": ts.chargeback_all,
                                   "price": ts.price, "sectors": ts.sectors, "owners": ts.owners,
                                   "capabilities": ts.capabilities, "forecast": forecast_table.read(),
                                   "runs": log.state()}).unionByName(kept.violations())
        bad = [r.check_name for r in q15.collect() if not r.ok]
        return {"row_counts_ok": all(r.ok for r in q1.collect()), "orphans": kept.orphan_usage().first().orphan_rows,
                "variance_pct": kept.cost_variance().first().variance_pct, "constraint_violations": bad,
                "months_checked": len(months)}

    lease = log.acquire("pipeline")          # JobActive: another run of this root is on
    try:
        for name, fn in (("usage", usage_step), ("cost", cost_step), ("chargeback", chargeback_step),
                         ("allocation", allocation_step), ("forecast", forecast_step),
                         ("views", views_step), ("checks", checks_step)):
            step(name, fn)
    except Exception:  # noqa: BLE001 - the status frame says which step failed
        pass
    finally:
        log.release("pipeline", lease)
    return spark.createDataFrame(status, "step string, status string, seconds double, info string")
