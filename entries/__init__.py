"""The registered queries and their SQL counterparts."""

import sys

from pyspark import cloudpickle

# As in flowplan: the user model of a query travels to the Python workers whole.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
