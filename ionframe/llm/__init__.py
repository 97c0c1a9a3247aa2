"""Operators of a training-data pipeline over documents and embeddings."""

import sys

from pyspark import cloudpickle

# Functions of this package travel to the executors with the job, so these need no copy of it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
