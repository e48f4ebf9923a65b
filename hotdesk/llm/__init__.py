"""Operators for preparing training text. Nothing else in the library imports them.

Functions that run inside tasks travel to the executors by value, so the executors need no
copy of this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
