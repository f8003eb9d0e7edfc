"""Operators for training-data pipelines: filter, deduplicate, score, pack, shard.

Nothing else in the library imports this subpackage.
"""

import sys

from pyspark import cloudpickle

# Task functions of this subpackage travel inside their closures, so executors
# need no copy of the repository on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
