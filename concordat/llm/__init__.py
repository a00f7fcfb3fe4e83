"""Operators of a training-data pipeline, each one module; ``queries`` registers them over the test tables.

Functions of this package that run in Python workers travel by value, so workers need no copy of it.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
