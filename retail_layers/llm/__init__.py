"""Training-data operators: dedup, filters, search, extraction and mixing on plain DataFrames."""

import sys

from pyspark import cloudpickle

# functions of this package travel by value, so executors need no copy of the package
cloudpickle.register_pickle_by_value(sys.modules[__name__])
