"""Operators for preparing text corpora: filters, near-duplicate search, packing, sharding.

Every operator is a function on DataFrames with its own general interface;
``registry`` holds the thin queries over the given tables.
"""

import sys

from pyspark import cloudpickle

# Functions that run in tasks travel with the job, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
