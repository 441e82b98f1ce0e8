"""Composable PySpark operators for tables and streams."""

import sys

from pyspark import cloudpickle

# Python functions handed to Spark travel by value, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
