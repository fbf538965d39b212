"""Operators for large-scale training-data pipelines (text corpora).

One module per operator; ``queries`` registers them.  Nothing else in the
library imports this package.  Functions that run in Python workers are
pickled by value, so executors need Spark, numpy and pyarrow only.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
