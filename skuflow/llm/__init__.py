"""Operators for a large-scale training-data pipeline (ten operators, one pipeline).

Their Python functions travel to the executors by value, so that a cluster needs the
libraries but no copy of this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
