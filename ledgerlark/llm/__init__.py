"""Operators for preparing training text at scale. Nothing else in the package imports this one.

Functions of these modules travel to the executors by value, so that a job
needs no copy of the package there.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
