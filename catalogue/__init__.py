"""Queries of the library on the given tables, with equivalent SQL for another engine."""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
