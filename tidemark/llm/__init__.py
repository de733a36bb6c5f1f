"""Operators for preparing text corpora; nothing else in the library imports this subpackage.

Task functions travel by value, so executors need no copy of this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
