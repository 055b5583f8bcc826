"""Import every module that registers queries."""

from meterline.plans import registry  # noqa: F401
from meterline.plans import queries_core  # noqa: F401
from meterline.plans import queries_forecast  # noqa: F401
from meterline.plans import queries_reconcile  # noqa: F401
from meterline.plans import queries_ingest  # noqa: F401
from meterline.plans import queries_sinks  # noqa: F401
from meterline.plans import queries_quality  # noqa: F401
from meterline.plans import queries_extra  # noqa: F401
from meterline.plans import queries_reports  # noqa: F401
