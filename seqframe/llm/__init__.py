"""Operators for training-data corpora: filters, near-duplicate search, mixing and scoring.

Functions that run inside tasks are shipped to the workers by value, so executors need Spark,
numpy and pyarrow, but not this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
