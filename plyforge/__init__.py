"""Plyforge: a Spark-native warehouse and modeling-dataset engine."""

import sys

from pyspark import cloudpickle

# Functions travel to the workers by value: a cluster needs no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
