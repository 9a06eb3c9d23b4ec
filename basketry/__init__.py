"""Basketry: multi-store retail sales analytics written as Spark DataFrame jobs."""

import sys

from pyspark.cloudpickle import register_pickle_by_value

# The few Python functions that run in tasks travel with the job, so executors need no installed copy.
register_pickle_by_value(sys.modules[__name__])
