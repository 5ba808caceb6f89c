"""Operators for training-data corpora. Nothing else in the library imports this package."""

import sys

from pyspark import cloudpickle

# Functions that run inside tasks travel with the plan, so workers need no copy of the package on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
