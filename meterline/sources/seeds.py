"""Reference rows for the small dimensions.

These are literal, bounded tables: broadcasting them is always safe.
"""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F  # noqa: F401

from meterline.session import config_table

# --- fixed values: seed rows of the dimension tables -----------------------
OWNERS = [
    (1, "Unassigned", None, None),
    (2, "Platform Team", None, "IT Operations"),
    (3, "Monitoring Admin", None, "Observability"),
]
SECTORS = [
    (1, "Unassigned", "Applications without assigned sector"),
    (2, "Finance", "Financial systems and reporting"),
    (3, "Supply Chain", "Supply chain management"),
    (4, "Sales", "Sales and CRM systems"),
    (5, "IT Operations", "Internal IT infrastructure"),
    (6, "Corporate/Shared Services", "Shared enterprise services"),
    (7, "Global IT", "Global IT platform services"),
]
ARCHITECTURES = [
    (1, "Unknown", "Architecture not classified"),
    (2, "Monolithic", "Single-tier monolithic application"),
    (3, "Microservices", "Distributed microservices architecture"),
    (4, "Serverless", "Serverless/FaaS architecture"),
    (5, "Legacy", "Legacy mainframe or client-server"),
]
CAPABILITIES = [
    (1, "APM", "Application Performance Monitoring", "APM agent licensing"),
    (2, "MRUM", "Mobile Real User Monitoring", "Mobile RUM licensing"),
    (3, "BRUM", "Browser Real User Monitoring", "Browser RUM licensing"),
    (4, "ANALYTICS", "Analytics", "Analytics platform licensing"),
    (5, "INFRA", "Infrastructure Monitoring", "Infrastructure visibility"),
]
# Price list used with the driver's lineitem star (capabilities 4-5 unpriced).
PRICES = [
    (1, 1, "Peak", "0.7500", "1995-01-01", "1998-12-31"),
    (2, 1, "Peak", "0.8000", "1999-01-01", None),
    (3, 1, "Pro", "0.5000", "1995-01-01", None),
    (4, 2, "Peak", "0.6000", "1995-01-01", None),
    (5, 2, "Pro", "0.4000", "1995-01-01", None),
    (6, 3, "Peak", "0.5500", "1995-01-01", None),
    (7, 3, "Pro", "0.3500", "1995-01-01", None),
]
ALLOCATION_RULES = [
    (1, "Platform Services - Proportional", "proportional_usage", "PLATFORM", None, True),
    (2, "Global IT - Equal Split", "equal_split", "GLOBAL_IT", None, True),
    (3, "Shared Services - Custom Formula", "custom_formula", "SHARED_SVC", None, True),
]
SHARED_SECTOR_NAMES = ("Corporate/Shared Services", "Global IT")
SHARED_HCODE_MARKERS = ("PLATFORM", "SHARED", "GLOBAL")
DEFAULT_UNIT_RATE = Decimal("0.50")
# ---------------------------------------------------------------------------


def owners(spark: SparkSession) -> DataFrame:
    return config_table(spark, OWNERS, "owner_id int, owner_name string, email string, department string")


def sectors(spark: SparkSession) -> DataFrame:
    return config_table(spark, SECTORS, "sector_id int, sector_name string, description string")


def architectures(spark: SparkSession) -> DataFrame:
    return config_table(spark, ARCHITECTURES, "architecture_id int, pattern_name string, description string")


def capabilities(spark: SparkSession) -> DataFrame:
    return config_table(spark, CAPABILITIES,
        "capability_id int, capability_code string, capability_name string, description string")


def prices(spark: SparkSession, rows=None) -> DataFrame:
    rows = PRICES if rows is None else rows
    data = [(pid, cap, tier, Decimal(rate), dt.date.fromisoformat(s),
             dt.date.fromisoformat(e) if e else None)
            for pid, cap, tier, rate, s, e in rows]
    return config_table(spark, data, "price_id int, capability_id int, tier string, unit_rate decimal(10,4), "
              "start_date date, end_date date")


def allocation_rules(spark: SparkSession, rows=None) -> DataFrame:
    return config_table(spark, ALLOCATION_RULES if rows is None else rows,
        "rule_id int, rule_name string, distribution_method string, "
        "shared_service_code string, applies_to_sector_id int, is_active boolean")
