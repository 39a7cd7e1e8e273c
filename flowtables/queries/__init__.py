"""Registered queries over the test tables, each with the DuckDB SQL that must give the same rows."""

from flowtables.queries import analytic, relational, sources, streaming, windowed  # noqa: F401
from flowtables.queries.base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
