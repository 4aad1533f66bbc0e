"""Operators of a training-data pipeline. Nothing outside this package imports it.

Task code is sent to executors by value, so they need no copy of the package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
