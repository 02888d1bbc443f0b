"""Operators for preparing training text at scale. Nothing else in the library imports this package."""

import sys

from pyspark import cloudpickle

# What tasks call travels with them, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
