"""Relevance ranking of companies and documents on Spark DataFrames."""

import sys

from pyspark import cloudpickle

# Functions sent to workers travel with their code, so that the package need
# not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
