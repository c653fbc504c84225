"""Build and analyse persona chat data with Spark DataFrames."""

import sys

from pyspark import cloudpickle

# functions of the package travel with the tasks that use them, so workers need no copy of it
cloudpickle.register_pickle_by_value(sys.modules[__name__])
