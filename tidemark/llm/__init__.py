"""Operators for preparing training data.  Nothing outside this subpackage imports it."""

import sys

from pyspark import cloudpickle

# Functions of this subpackage travel to the executors by value, so a cluster needs no
# installed copy of it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
