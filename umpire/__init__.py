"""Spark-native data engine for a tabular binary classifier's pipeline.

Functions shipped to Python workers (the few ``mapInPandas`` steps) are
pickled by value, so executors need no copy of this package installed.
"""

import sys

from pyspark import cloudpickle as _cloudpickle

_cloudpickle.register_pickle_by_value(sys.modules[__name__])
