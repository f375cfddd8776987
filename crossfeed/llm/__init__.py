"""Operators for large-scale training-data pipelines. Nothing else in the library imports this subpackage."""

import sys

from pyspark import cloudpickle

# Functions of these modules travel to the Python workers with the job, so workers need no copy of the library.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
