"""ionframe: Spark-native DataFrame operators for mass-spectrometry proteomics.

Every operator is a plain function that takes DataFrames plus column names and
returns a lazy DataFrame; Spark plans, partitions and shuffles the work.
"""

import sys

from pyspark import cloudpickle

# Functions of the library travel to the executors with the job, so these need no copy of it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__version__ = "0.1.0"
