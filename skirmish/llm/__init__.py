"""Training-data operators: fingerprints, sharding, near-duplicates, token files, filters, packing, BPE.

Nothing else in the library imports this subpackage.  Task functions are pickled by value, so
Python workers run them without having to import the package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
