"""casaframe: tabular preparation, validation, training, scoring and drift on Spark."""

import sys as _sys

from pyspark import cloudpickle as _cloudpickle

__version__ = "0.1.0"

# Functions that run inside Python workers (pandas UDFs, mapInPandas) are
# shipped by value, so executors do not need the package installed or on
# their path.
_cloudpickle.register_pickle_by_value(_sys.modules[__name__])
