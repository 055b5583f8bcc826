"""Scalar rules as built-in Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values ------------------------------------------------------------
# Licence tier keywords (case-insensitive substring; "prod" also covers "production").
PEAK_PATTERN = "prod|critical|enterprise|premium"
# Tag names that may carry the cost code, in priority order.
HCODE_TAG_NAMES = ("h-code", "h_code", "hcode")
# Strings read as true by the loose boolean parser.
TRUE_STRINGS = ("true", "True", "1", "yes")
# Display names of the licence tiers.
TIER_LABELS = {"Peak": "Peak (Enterprise)", "Pro": "Pro (Standard)"}
# Savings factor when a Peak licence is moved to Pro.
PEAK_TO_PRO_KEEP = "0.67"
PEAK_TO_PRO_SAVE = "0.33"
# Architecture thresholds
MICRO_MIN_TIERS = 4
MICRO_MIN_TIERS_WITH_NODES = 2
MICRO_MIN_NODES = 10
# ------------------------------------------------------------------------------


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def license_tier(name, description) -> Column:
    """P01: 'Peak' when name or description mentions a production keyword."""
    text = F.lower(F.concat_ws("\n", _c(name), _c(description)))
    return F.when(text.rlike(PEAK_PATTERN), F.lit("Peak")).otherwise(F.lit("Pro"))


def architecture_name(tier_count, node_count) -> Column:
    """P02 (by name, see R1): Microservices vs Monolithic."""
    t, n = F.coalesce(_c(tier_count), F.lit(0)), F.coalesce(_c(node_count), F.lit(0))
    micro = (t >= MICRO_MIN_TIERS) | ((t >= MICRO_MIN_TIERS_WITH_NODES) & (n >= MICRO_MIN_NODES))
    return F.when(micro, F.lit("Microservices")).otherwise(F.lit("Monolithic"))


def safe_truncate(col, n: int) -> Column:
    """empty/null -> null, else the first ``n`` characters."""
    return F.substring(F.nullif(_c(col), F.lit("")), 1, n)


def hcode_from_tags(tags_map) -> Column:
    """First non-empty of the h-code tag spellings."""
    m = _c(tags_map)
    return F.coalesce(*[F.nullif(F.element_at(m, F.lit(k)), F.lit("")) for k in HCODE_TAG_NAMES])


def loose_bool(col) -> Column:
    """P05: 'true'/'True'/'1'/'yes' (or boolean true) -> true; anything else false."""
    c = _c(col).cast("string")
    return F.coalesce(c.isin(*TRUE_STRINGS), F.lit(False))


def safe_ratio(num, den, zero=0) -> Column:
    """n/d when d > 0 else ``zero`` (ANSI-safe)."""
    d = _c(den)
    return F.when(d > 0, F.try_divide(_c(num), d)).otherwise(F.lit(zero))


def tier_label(tier) -> Column:
    """P10: display label of a tier."""
    t = _c(tier)
    expr = t
    for k, v in reversed(list(TIER_LABELS.items())):
        expr = F.when(t == k, F.lit(v)).otherwise(expr)
    return expr


def tier_norm(tier, default="UNKNOWN") -> Column:
    """upper(coalesce(tier, default))."""
    return F.upper(F.coalesce(_c(tier), F.lit(default)))


def cycle_label(cycle) -> Column:
    """P18 literal: 'direct' -> Direct Costs, 'shared' -> Shared Services, else other."""
    c = _c(cycle)
    return (F.when(c == "direct", F.lit("Direct Costs"))
             .when(c == "shared", F.lit("Shared Services"))
             .otherwise(F.lit("Other Allocations")))


def cycle_label_fixed(cycle) -> Column:
    """P18 corrected (R9): every ``allocated%`` cycle counts as shared."""
    c = _c(cycle)
    return (F.when(c == "direct", F.lit("Direct Costs"))
             .when((c == "shared") | c.startswith("allocated"), F.lit("Shared Services"))
             .otherwise(F.lit("Other Allocations")))


def year_month(d) -> Column:
    """TO_CHAR(d, 'YYYY-MM')."""
    return F.date_format(_c(d), "yyyy-MM")


def month_name_padded(d) -> Column:
    """TO_CHAR(d, 'Month') is blank-padded to 9 characters."""
    return F.rpad(F.date_format(_c(d), "MMMM"), 9, " ")


def peak_savings(peak_cost) -> Column:
    """C11 (view form): peak - peak*0.67 when peak > 0, else 0."""
    p = _c(peak_cost)
    return F.when(p > 0, p - p * F.lit(PEAK_TO_PRO_KEEP).cast("decimal(3,2)")).otherwise(F.lit(0))


def id_suffix_number(col, start: int) -> Column:
    """Integer value of ``substring(id, start)`` (null when not numeric)."""
    return F.substring(_c(col), start, 1 << 20).try_cast("int")


def merge_metadata_struct(old, new) -> Column:
    """P12 (typed metadata): field by field, the new value wins when present (shallow merge)."""
    o, n = _c(old), _c(new)
    return F.struct(F.coalesce(n["description"], o["description"]).alias("description"),
                    F.coalesce(n["tier_count"], o["tier_count"]).alias("tier_count"),
                    F.coalesce(n["node_count"], o["node_count"]).alias("node_count"))


def merge_metadata_map(old, new) -> Column:
    """P12 (free-form metadata map): shallow merge, right side wins, independent of the
    session's map key dedup policy."""
    o, n = _c(old), _c(new)
    kept = F.map_filter(o, lambda k, v: ~F.array_contains(F.map_keys(n), k))
    return F.map_concat(kept, n)
