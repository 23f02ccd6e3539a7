"""Lead, fund and market analytics as DataFrame-to-DataFrame operators."""

import sys

from pyspark import cloudpickle

# the small functions that run in Python workers travel with the plan, so executors need no copy of this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])
