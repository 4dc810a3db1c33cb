"""Registered queries over the given tables, each with its SQL equivalent where SQL can state it."""

import sys

from pyspark import cloudpickle

# The stand-in embedder travels with the job.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

from workload import (  # noqa: E402, F401
    archive_queries,
    identity_queries,
    media_queries,
    search_queries,
    sink_queries,
    transcript_queries,
)
from workload.catalog import ORACLES, QUERIES  # noqa: E402

__all__ = ["ORACLES", "QUERIES"]
