"""The registry of queries; importing it loads every module of queries."""

from . import basics, checks, finance, products, scoped, storage  # noqa: F401
from .registry import QUERIES, TWINS

__all__ = ["QUERIES", "TWINS"]
