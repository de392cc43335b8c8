"""Operators for preparing training text. Nothing else in the library imports this package.

Functions that run on executors are pickled by value, so executors need none
of this package installed.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
