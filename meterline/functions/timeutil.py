"""``as_of`` arithmetic: every time window is a literal computed here, so
predicates on the raw ``ts`` column reach the Parquet scan and month
partition pruning stays deterministic (no ``current_timestamp()``)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_date(d) -> dt.date:
    if isinstance(d, dt.datetime):
        return d.date()
    if isinstance(d, dt.date):
        return d
    return dt.date.fromisoformat(str(d))


def add_months(d: dt.date, n: int) -> dt.date:
    """Calendar month arithmetic with end-of-month clamping (as SQL intervals do)."""
    y, m = divmod(d.month - 1 + n, 12)
    y += d.year
    m += 1
    for day in (d.day, 31, 30, 29, 28):
        try:
            return dt.date(y, m, min(d.day, day))
        except ValueError:
            continue
    raise ValueError(d)


def month_start(d: dt.date) -> dt.date:
    return dt.date(d.year, d.month, 1)


def days_before(as_of, days: int) -> dt.datetime:
    d = as_date(as_of)
    return dt.datetime(d.year, d.month, d.day) - dt.timedelta(days=days)


def months_before(as_of, months: int) -> dt.datetime:
    d = add_months(as_date(as_of), -months)
    return dt.datetime(d.year, d.month, d.day)


def ts_lit(t: dt.datetime) -> Column:
    """A TIMESTAMP_NTZ literal (matches the type of the fact ``ts`` columns)."""
    return F.expr(f"TIMESTAMP_NTZ'{t:%Y-%m-%d %H:%M:%S}'")


def date_lit(d) -> Column:
    return F.lit(as_date(d))


def sql_ts(t: dt.datetime) -> str:
    """The same literal as SQL text (portable between Spark SQL and DuckDB)."""
    return f"TIMESTAMP '{t:%Y-%m-%d %H:%M:%S}'"


def sql_date(d) -> str:
    return f"DATE '{as_date(d).isoformat()}'"


PARTITION_COL = "month"


def since(df, t: dt.datetime, ts_col: str = "ts"):
    """``ts >= t`` on a fact; when the fact is a month-partitioned table (has a ``month``
    partition column) the implied ``month >= trunc(t)`` is added so whole partitions are pruned."""
    out = df.where(F.col(ts_col) >= ts_lit(t))
    if PARTITION_COL in df.columns:
        out = out.where(F.col(PARTITION_COL) >= F.lit(dt.date(t.year, t.month, 1)))
    return out
