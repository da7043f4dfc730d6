"""Operators for large training-data pipelines: one module per numbered operator, plus their queries and SQL.

Functions that run in Spark's Python workers are pickled by value, so executors need no copy of this package.  Broadcast
values are pickled plainly: they hold arrays and plain values, never objects of this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
