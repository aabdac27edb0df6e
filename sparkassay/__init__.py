"""Spark-native analysis of tabular binary-classification data."""

import sys

from pyspark import cloudpickle

from sparkassay.roles import Roles

# Task functions travel with the job, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__all__ = ["Roles"]
