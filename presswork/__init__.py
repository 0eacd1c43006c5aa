"""Presswork: news and document analytics as PySpark DataFrame transforms."""

import sys

from pyspark import cloudpickle

# Python functions of this package travel to the executors by value, so a job
# needs no installation of the package on the worker machines.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
