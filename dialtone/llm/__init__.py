"""Operators for preparing large text corpora.

Nothing outside this folder (and ``corpus_pipeline.py``) imports it. Functions
that run in Python workers are sent to the executors by value, so a cluster
needs no copy of this package on its workers.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
