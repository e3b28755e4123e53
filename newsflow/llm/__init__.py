"""Operators for large-scale training-data preparation.

The functions that run in Python workers are sent with the job, so executors need no copy of this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
