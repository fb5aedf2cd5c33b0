"""The data side of retrieval-augmented question answering, as Spark jobs."""

import sys

from pyspark import cloudpickle

# Functions of this package travel to the executors with the job, so that it need not be
# installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
