"""Operators for training text: joins, filters, redaction, tokens. Nothing else in the library imports them.

Task functions travel to the executors by value, so a cluster needs no copy of this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
