"""barloom: price-history analytics for many symbols at once, as Spark DataFrame jobs."""

import sys

from pyspark import cloudpickle

from barloom.session import build_session

# Functions sent to Python workers travel by value, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__all__ = ["build_session"]
