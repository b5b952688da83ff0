"""Registered queries over the given tables, each with its SQL counterpart."""

from twinledger.suite import (  # noqa: F401
    compare,
    corpus,
    counting,
    loading,
    scanning,
    schemas,
)
from twinledger.suite.registry import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
