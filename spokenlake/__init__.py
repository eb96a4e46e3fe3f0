"""spokenlake: a PySpark-native analytics engine for spoken-content and web-text corpora."""

import sys

from pyspark import cloudpickle

# Functions handed to Python workers travel with their code, so executors need no copy of this package on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
