"""Operators for preparing training text: scoring, dedup, decontamination, tokenising, archives and vector search.

Nothing outside this folder imports it. Functions that run in Python workers travel by value, so that executors need no
copy of the package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
