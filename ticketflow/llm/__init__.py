"""Operators that prepare text for training: deduplication, quality, secrets, scoring, mixing."""

import sys

from pyspark import cloudpickle

# Functions that run in Spark's Python workers travel with the job, so executors need no copy of the library.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
