"""Spark-native analytics for page, detection, annotation and training-text tables."""

import sys

from pyspark import cloudpickle

# Kernels travel to the executors by value: no executor needs this package on its path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__version__ = "0.1.0"
