"""Text-corpus cleaning, de-duplication and evaluation on Spark DataFrames."""

import sys

from pyspark import cloudpickle

# Functions of this package travel to the workers with the job, so that executors do
# not need it installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
