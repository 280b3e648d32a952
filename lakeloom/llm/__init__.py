"""Operators of a training-data pipeline: filters, classifiers, near-duplicates, search, mixing.

Functions that run in worker processes travel with the job, so executors need not have this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
