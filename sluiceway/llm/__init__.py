"""Operators for training data: one module each, and the queries that apply them.

Nothing else in the library imports this package.
"""

import sys

from pyspark import cloudpickle

# Functions of this package travel to the executors whole; it need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
