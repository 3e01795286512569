"""Operators of a training-data pipeline. Nothing outside this subpackage imports it."""

import sys

from pyspark import cloudpickle

# Functions that run in Python workers travel with the job, so that executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
