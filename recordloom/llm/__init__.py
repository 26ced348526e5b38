"""Operators for large training corpora; nothing else in the library depends on them."""

import sys

from pyspark import cloudpickle

# functions reach the executors by value, so that they need no copy of this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])
