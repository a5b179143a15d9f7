"""Training-data operators: mixing, near and exact duplicates, search, tokens, filters.

Nothing else in the library imports this subpackage. Its functions travel to the
executors by value, so a cluster needs no installed copy of it.
"""

import sys as _sys

from pyspark import cloudpickle as _cloudpickle

_cloudpickle.register_pickle_by_value(_sys.modules[__name__])
