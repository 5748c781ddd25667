"""Readers and writers."""

import sys

from pyspark import cloudpickle

# tasks get these modules with their functions, so that executors need no copy of the library
cloudpickle.register_pickle_by_value(sys.modules[__name__])
