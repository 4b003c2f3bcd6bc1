"""Training-data operators over document, label, benchmark and conversation tables."""

import sys

from pyspark import cloudpickle

# Python workers get this package's functions with the task, so executors need no copy of it on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
