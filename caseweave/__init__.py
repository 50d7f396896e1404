"""Support-conversation analytics as Spark plans: audit, threads, TF-IDF retrieval, triage, evaluation."""

import sys

from pyspark import cloudpickle

# Functions of this package travel to the workers by value, so workers do not need the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
