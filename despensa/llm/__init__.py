"""Operators of a training-data pipeline over documents, pages, benchmark items and embeddings.

Nothing else in the library imports this package. Its functions travel with the job, so executors
need no copy of it.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
