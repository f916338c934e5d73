"""Land, address, valuation, sale and boundary analytics on Spark DataFrames."""

import sys

from pyspark import cloudpickle

# Python workers get the few helper functions they run by value, so the package
# need not be installed on the executors.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
