"""flowplan: demand forecasting and shipment planning on logistics networks, as Spark DataFrames."""

import sys

from pyspark import cloudpickle

# Functions sent to Python workers travel whole, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
