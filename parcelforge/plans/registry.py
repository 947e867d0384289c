"""Every registered query of the library and, where SQL can say it, its DuckDB counterpart."""

from __future__ import annotations

from . import exchange, fields, relational, resolution, values  # noqa: F401  registering
from .register import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
