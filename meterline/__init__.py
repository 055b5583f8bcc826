"""meterline: licence usage -> cost -> chargeback -> forecast analytics on Spark.

Every public function takes DataFrames (plus an explicit ``as_of`` date
where time matters) and returns a lazy DataFrame; only
``meterline.sources.sinks`` writes.
"""

import sys as _sys

# Python code that runs inside tasks is pickled by value, so executors need no installed copy of this package.
from pyspark import cloudpickle as _cloudpickle

_cloudpickle.register_pickle_by_value(_sys.modules[__name__])

from meterline.session import get_spark, checkpoint_dir  # noqa: E402

__all__ = ["get_spark", "checkpoint_dir"]
