from pyspark.sql import functions as F

from meterline.plans.pipeline import TableStar, run_pipeline
from meterline.sources import seeds
from meterline.sources.runlog import RunLog
from meterline.sources.star import Star
from meterline.sources.versions import Table

from conftest import SF_SMALL


def _rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_pipeline_tables_reproduce_views_and_a_rerun_posts_only_the_months_given(spark, tmp_path):
    root = str(tmp_path / "wh")
    st = run_pipeline(spark, SF_SMALL, root).collect()
    assert all(r.status == "success" for r in st), [(r.step, r.info) for r in st]
    base, tables = Star(spark, SF_SMALL), TableStar(Star(spark, SF_SMALL), root)
    for v in ("v1", "v5", "v6", "v7"):          # published versions
        assert _rows(getattr(tables, v)) == _rows(getattr(base, v))
    assert _rows(TableStar(Star(spark, SF_SMALL), root, use_published=False).v2) == _rows(base.v2)
    posted, cost, usage = (Table(spark, f"{root}/{n}", by) for n, by in (("chargeback_fact", "month_start"), ("license_cost_fact", "month"),
                                                                        ("license_usage_fact", "month")))
    shared = F.col("chargeback_cycle").like("allocated%")
    before = posted.read().collect()
    months = sorted({r.month_start for r in before if r.chargeback_cycle.startswith("allocated")})
    # the rules are switched off, and one month is posted again
    off = seeds.allocation_rules(spark, [(*r[:-1], False) for r in seeds.ALLOCATION_RULES])
    st2 = {r.step: r for r in run_pipeline(spark, SF_SMALL, root, months=months[:1], rules=off).collect()}
    assert all(r.status == "success" for r in st2.values()), st2
    assert st2["allocation"].info == st2["chargeback"].info == "{'months': 1}"
    want = [r for r in before if r.month_start != months[0] or r.chargeback_cycle == "direct"]
    assert _rows(posted.read()) == sorted(map(tuple, want), key=repr)
    assert posted.read().where(shared & (F.col("month_start") == F.lit(months[0]))).isEmpty()
    assert cost.read().count() == base.cost.count()
    assert usage.read().count() == base.usage.count()
    log = RunLog(spark, f"{root}/run_log")
    assert log.last_success("allocation") is not None and not log.is_active("allocation")
