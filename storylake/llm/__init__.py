"""Operators for preparing training data: mixing, filtering, counting, extracting, deduplicating.

Nothing else in the library imports this subpackage.  ``queries`` holds the registered queries.
"""

import sys

from pyspark import cloudpickle

# Python workers may start in another folder, so functions travel with their code.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
