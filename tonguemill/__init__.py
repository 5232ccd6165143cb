"""Measure, price and carry out the translation of text corpora on Spark."""

import sys

from pyspark import cloudpickle

# Tasks carry this package's functions with them: executors need no copy of it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
