"""Training-data operators: scoring, filtering, mixing, sharding, deduplication, tokens, archives.

Functions of this subpackage travel to executors by value, so executors need numpy, pandas
and pyarrow but not this repository.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
