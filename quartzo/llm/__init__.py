"""Operators of a training-data pipeline. Functions for tasks are shipped by value: executors need no copy of the package."""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
