"""Operators of a large-scale training-data pipeline: deduplication, similarity joins, classifiers,
chat formatting, packing, scans, URL rules and benchmark decontamination.

Nothing else in the library imports this subpackage.
"""

import sys

from pyspark import cloudpickle

# Task functions travel with their code, so executors need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
