"""Analytics over company registries and web corpora as PySpark DataFrame operators."""

import sys as _sys

from pyspark import cloudpickle as _cloudpickle

# Functions that run on executors travel with their task, so the package need not be installed there.
_cloudpickle.register_pickle_by_value(_sys.modules[__name__])
