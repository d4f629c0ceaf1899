"""Operators for large training-data pipelines; nothing else in the library imports them.

Functions of this subpackage are sent to Python workers by value, so executors
need numpy, pandas and the like, but no copy of the library.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
