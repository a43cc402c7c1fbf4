"""Operators for preparing training text at scale.

Thirteen operators over ``documents``, ``pages``, ``embeddings`` and
``benchmark`` tables, the queries that apply them (``queries.py``) and shared
helpers (``common.py``).
Nothing outside this package imports it.

The functions that run in Python workers are shipped by value, so executors
need numpy, pyarrow and the text libraries, but not this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
