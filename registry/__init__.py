"""The library's operators as queries over the test tables."""

from registry import collect, files, labels, text  # noqa: F401
from registry.base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
