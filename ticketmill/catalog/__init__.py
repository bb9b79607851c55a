"""Runnable queries, each next to the SQL that must give the same rows."""

from . import (  # noqa: F401
    columns, facts, filters, jobs, joins, marts, quality, storage, streaming,
)
from .core import ORACLES, QUERIES  # noqa: F401
