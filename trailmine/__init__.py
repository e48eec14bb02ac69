"""Search-log mining on Spark: sessions, refinements, clusters, suggestions."""

import sys

from pyspark import cloudpickle

from trailmine.session import build_spark

# The few group functions travel with the job, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__all__ = ["build_spark"]
