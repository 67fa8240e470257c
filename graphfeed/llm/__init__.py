"""Operators for preparing text corpora; nothing outside this folder imports them.

Their Python functions travel to the executors by value, so workers need no copy of the package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
