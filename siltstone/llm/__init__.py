"""Operators for building training data at scale, their queries and the SQL stating their results.

Functions that run inside tasks travel to the executors by value, so nothing of this library has to be
installed there.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
