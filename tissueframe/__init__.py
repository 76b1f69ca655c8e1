"""tissueframe: spatial-tissue analytics as PySpark DataFrame operators."""

import sys

from pyspark import cloudpickle

# Functions shipped to executors (Arrow kernels, file readers) travel by value,
# so a cluster needs no copy of this package on its workers.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__version__ = "0.1.0"
