"""Training-data operators: mixing, quality, near duplicates, decontamination, toxicity, repeated passages,
host rules, revisit records, token files, line removal, embedding whitening, periodic runs and packing.

Nothing else in the library imports this subpackage.  Functions that run inside Python workers are pickled by
value, so executors need no copy of the package on their path.
"""

from pyspark import cloudpickle as _cloudpickle

import sys as _sys

_cloudpickle.register_pickle_by_value(_sys.modules[__name__])
