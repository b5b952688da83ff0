"""Operators for preparing training data, and the queries that apply them."""

import sys

from pyspark import cloudpickle

# Tasks get this package's functions with the plan: executors need no copy of it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

from twinledger.llm.queries import ORACLE, QUERIES  # noqa: E402

__all__ = ["ORACLE", "QUERIES"]
