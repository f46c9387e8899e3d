"""Spark-native annotation analytics: protein positions, structures and their evidence."""

import sys

from pyspark import cloudpickle

# Functions that run in Python workers travel whole: executors need not have the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
