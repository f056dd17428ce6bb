"""Operators a training-data pipeline needs: dedup, filters, search, sharding, packing."""

import sys

from pyspark import cloudpickle

# Functions travel to the tasks by value, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
