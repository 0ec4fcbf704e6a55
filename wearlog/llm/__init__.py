"""Operators of a training-data pipeline: documents, embeddings and benchmark items."""

import sys

from pyspark import cloudpickle

# What runs in tasks is sent along whole: executors need Spark's Python and the libraries, not this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
