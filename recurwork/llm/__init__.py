"""Operators for preparing training text at scale.

Nothing else in the library imports this subpackage.  Functions that run in
Python workers are shipped by value, so a job needs no copy of the package on
the executors.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
