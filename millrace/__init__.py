"""Event-lakehouse operators on Spark DataFrames and Structured Streaming."""

import sys

from pyspark import cloudpickle

__version__ = "0.1.0"

# The few functions that run in Python workers travel with their task, so the executors do
# not need this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
