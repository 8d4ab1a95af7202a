"""Customer-support triage on Spark: pairing, cleaning, sampling, retrieval, policy and evaluation.

Every operator takes DataFrames (or Columns) and returns a DataFrame (or Column); nothing is collected
unless its size has been checked first.
"""

import sys

from pyspark import cloudpickle

# Functions of this package travel to the Python workers by value, so the package need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
