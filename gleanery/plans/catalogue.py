"""Every registered query with its DuckDB counterpart."""

from __future__ import annotations

from gleanery.plans import fields, intake, pages, pairs, papers, registries, reports, retrieve, streams, text  # noqa: F401  they register themselves
from gleanery.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
