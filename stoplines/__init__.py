"""Timetable and delay analytics on Spark: DataFrames in, DataFrames out."""

import sys

from pyspark import cloudpickle

# The few functions that run in Python workers are sent by value, so executors need
# no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
