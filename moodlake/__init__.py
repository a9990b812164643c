"""Spark-native sentiment analytics over tables and streams of short posts."""

import sys

from pyspark import cloudpickle

# Python functions travel to the executors by value, so they need no copy of
# this package there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
