"""Training-data operators: one module per operator, queries and oracle SQL in ``queries``.

Functions of this package that run in tasks are sent by value, so executors need no copy of it.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
