"""Raster, matrix and run-log analytics on Spark DataFrames.

Images are tables of pixels ``(image_id, y, x, b, g, r)``, matrices are tables
of entries ``(i, j, v)`` and benchmark logs are tables of runs.
"""

import sys

from pyspark import cloudpickle

# Functions that run in tasks travel with the job, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
