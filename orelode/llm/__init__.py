"""Operators for preparing training text: joins, scans, cleaning, sampling and packing.

Functions of this package travel to the executors by value, so that these need no copy of
the library on their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
