"""Operators for preparing training text at scale.

Nothing else in the package imports this one. Its functions travel to the
Python workers by value, so executors need no copy of the package.
"""

import sys

from pyspark.cloudpickle.cloudpickle import register_pickle_by_value

register_pickle_by_value(sys.modules[__name__])
