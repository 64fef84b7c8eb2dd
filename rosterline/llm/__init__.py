"""Operators over text corpora. Their Python parts travel to the executors with the jobs."""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
