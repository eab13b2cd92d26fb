"""Financial planning and analysis operators for PySpark DataFrames."""

import sys

from pyspark import cloudpickle

__version__ = "0.1.0"

# functions sent to executors carry their code, so that only the driver needs the package
cloudpickle.register_pickle_by_value(sys.modules[__name__])
