"""Spark-native corpus preparation, chat-data preparation and text-generation scoring."""

import sys

from pyspark import cloudpickle

# Python workers need not have the package on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
