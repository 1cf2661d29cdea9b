"""Operators of a training-data pipeline. Nothing else in the library imports this subpackage."""

import sys

from pyspark import cloudpickle

# Task functions travel with the job: an executor needs no copy of this package on its path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
