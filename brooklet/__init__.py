"""Event and change-data analytics on the PySpark DataFrame and Structured Streaming APIs."""

import sys

from pyspark import cloudpickle

# Helpers used inside Python tasks travel with them, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
