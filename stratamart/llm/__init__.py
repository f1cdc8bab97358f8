"""Operators that prepare training data; nothing else in the library imports this."""

import sys

from pyspark import cloudpickle

# Tasks carry this package's code with them, so executors need no copy of the library.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
