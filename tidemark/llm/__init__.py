"""Operators for preparing language-model training data.

Functions that run in Python workers are shipped by value, so that executors
need this package's dependencies but not the package itself.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
