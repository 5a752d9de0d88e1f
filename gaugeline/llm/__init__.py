"""Training-data operators: packing, tokens, filters, near duplicates, extraction, scoring."""

import sys

from pyspark import cloudpickle

# Functions of this package travel to the executors with their code, so the package need
# not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
