"""Operators for preparing text corpora. Nothing else in the library imports
this subpackage.

Functions that run in tasks are sent to the executors by value, so the cluster
needs numpy, pandas and xxhash, but not this package."""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
