"""Every registered query of the core with the SQL it must agree with."""

from __future__ import annotations

from . import campaign, corpus, metrics, quality, records, streams, tasks, voices  # noqa: F401
from .registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
