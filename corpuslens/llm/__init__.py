"""Operators of a training-data pipeline; nothing else in the library imports this package."""

import sys

from pyspark import cloudpickle

# Executors receive the functions by value, so the package need not be installed on them.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
