"""Operators of a training-data pipeline, each one PySpark job over whole tables.

Nothing outside this subpackage (and ``corpus_pipeline.py``) imports it.
"""

import sys

from pyspark import cloudpickle

# Functions that run in tasks travel with the job, so executors need no copy of
# this package on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
