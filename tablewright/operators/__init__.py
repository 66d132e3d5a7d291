"""Operators on whole tables. What runs in worker processes is sent to them by value, so executors don't need this package."""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
