"""Text retrieval and batch scoring over Spark tables."""

import sys

from pyspark import cloudpickle

# Python functions of this package travel with the tasks, so executors need no copy of it installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
