"""Operators of a training-data pipeline: search, fingerprints, near-duplicate
removal, tokenizer work, filtering, packing and language-model scoring.

Nothing outside this folder imports it.  Python functions of the subpackage
are shipped to the executors by value, so a cluster needs no installed copy.
"""

import sys

from pyspark.cloudpickle import register_pickle_by_value

register_pickle_by_value(sys.modules[__name__])
