"""Registered queries over the provided tables, each with its DuckDB counterpart where one exists."""

from rtml.suite.base import ORACLES, QUERIES  # noqa: F401
from rtml.suite import (alerting, curves, encoding, joining, modelling,  # noqa: F401
                        profiles, projections, registry_queries, sampling, sql_queries, streams, texts)
