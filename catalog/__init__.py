"""The registered queries and their DuckDB twins."""

import sys

from pyspark import cloudpickle

# The stand-in scorer travels to the workers by value, like the functions of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
