"""codexflow: analytics over versioned public-document corpora, built on Spark DataFrames."""

import sys

from pyspark import cloudpickle

# Functions of the package travel with the tasks that use them, so executors need no installed copy.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
