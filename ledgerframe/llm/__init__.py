"""Operators for preparing training text, and the queries that apply them."""

import sys

from pyspark import cloudpickle

# functions sent to executors carry their code, so that only the driver needs the package
cloudpickle.register_pickle_by_value(sys.modules[__name__])
