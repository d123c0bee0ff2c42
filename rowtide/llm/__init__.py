"""Training-data operators: web archives, deduplication, quality, toxicity,
personal data, licenses, benchmark leaks, tokens and packing.

Nothing outside this package imports it. The functions that run inside tasks
are pickled by value, so executors need no copy of the package on their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
