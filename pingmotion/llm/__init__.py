"""Operators of a training-data pipeline. Nothing else in the library imports this package."""

import sys

from pyspark import cloudpickle

# Python tasks get these modules with their functions, so that executors need no copy of them.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
