"""quirework: assembling paginated documents into clean text, on Spark DataFrames."""

import sys

from pyspark import cloudpickle

# Functions that run on executors travel with the task, so executors need not have the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
