"""Road-network impact analytics as Spark DataFrame plans."""

import sys

from pyspark import cloudpickle

# Functions of this package travel to executors with the plan, so they need no installed copy there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
