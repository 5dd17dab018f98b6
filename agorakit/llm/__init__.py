"""Operators of a training-data pipeline: text, pages, sketches, packing, placement and audits.

Nothing else in the library imports this package. Its code travels with the
query, so executors need not have it installed.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
