"""Training-data operators: filters, scans, deduplication, mixing and tokenisation of text tables.

Nothing else in the package imports this subpackage.
"""

import sys

from pyspark import cloudpickle

# Tasks get the code by value: executors need not see the driver's folders.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
