"""Data-science operators written for Spark DataFrames."""

import sys

from pyspark import cloudpickle

# The few Python functions that run in tasks travel with the job, so executors need no install.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
