"""Operators that prepare training data; see each module for its method and its null rules."""

import sys

from pyspark import cloudpickle

# Functions of this package that run in Python workers travel with the plan, so that
# executors need no copy of the package on their import path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
