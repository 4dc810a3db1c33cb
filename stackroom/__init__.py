"""Heritage-record search, archive logs and transcript analytics as Spark DataFrame code."""

import sys

from pyspark import cloudpickle

# The few Python functions that run in tasks travel with the job, so executors need no installed package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
