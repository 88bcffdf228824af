"""Operators for preparing training text. Nothing else in the package imports this folder."""

import sys

from pyspark import cloudpickle

# Tasks get this folder's functions with the job, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
