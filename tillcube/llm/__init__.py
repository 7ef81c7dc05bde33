"""Operators of a training-data pipeline (near-duplicates, decontamination,
substring and suffix dedup, tokenisation, archives, URL and quality filters).

Nothing else in the library imports this package; ``queries.py`` lists its
registered queries.
"""

import sys

from pyspark import cloudpickle

# Task functions travel by value, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
