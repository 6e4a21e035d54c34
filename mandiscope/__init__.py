"""Marketplace listing analytics expressed as Spark DataFrame transforms."""

import sys

from pyspark import cloudpickle

# Functions of this package travel to the executors by value, so they need no installed copy.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
