"""Public-transport analytics as Spark jobs: raw feeds to answers."""

import sys

from pyspark import cloudpickle

# Functions of this package that run on executors travel with their tasks, so executors
# need no copy of it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
