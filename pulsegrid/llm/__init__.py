"""Operators for preparing large training corpora, as Spark jobs."""

import sys

from pyspark.cloudpickle import register_pickle_by_value

# Tasks get these functions by value, so that executors need no copy of the package.
register_pickle_by_value(sys.modules[__name__])
