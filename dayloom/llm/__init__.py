"""Training-data operators: one module per operator, `queries` and `oracle` on top.

Nothing else in the library imports this subpackage.  Functions that run
inside Spark's Python workers are pickled by value, so the executors need the
third-party packages only, not this repository on their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
