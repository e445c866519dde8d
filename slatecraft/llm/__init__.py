"""Operators for training-data corpora, with their queries."""

import sys

from pyspark import cloudpickle

# functions travel to the executors with their code, so these need no copy of the package
cloudpickle.register_pickle_by_value(sys.modules[__name__])
