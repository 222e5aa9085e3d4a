"""Parallaxis: Spark-native analytics for posed-image 3-D capture data.

Functions that reach Python workers are pickled by value, so executors need
no copy of this package on their import path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
