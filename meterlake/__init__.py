"""meterlake: features and analytics over language-model call events, on Spark."""

import sys

from pyspark import cloudpickle

__version__ = "0.1.0"

# Functions that run in Python workers are sent by value, so that the package
# does not have to be installed on the executors.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
