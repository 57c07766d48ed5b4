"""All registered queries, by name."""

from . import books, cleaning, drops, governance, history, jobs, sheets, structure  # noqa: F401
from .base import REGISTERED, Query

__all__ = ["REGISTERED", "Query"]
