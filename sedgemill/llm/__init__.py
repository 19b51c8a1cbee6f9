"""Operators of a training-data pipeline. Their functions travel with the jobs, so executors need no copy of this package."""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
