"""Training-data operators: packing, mixing, quality, deduplication, licences, PII.

Nothing else in the library imports this subpackage.  ``queries.QUERIES`` and
``queries.ORACLE`` hold its registered queries.
"""

import sys

from pyspark import cloudpickle

# Functions that run inside tasks travel with their code, so that executors
# need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
