"""The operators as queries over the given tables, each with its SQL check."""

import sys

from pyspark import cloudpickle

# The small functions handed to tasks travel by value, as the package's do.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
