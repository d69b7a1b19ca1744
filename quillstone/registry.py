"""Names and functions of the registered queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from quillstone.plans import graphs, linking, logs, network, payloads, people, performed, relational, serving, stores, textual

FLAGSHIP = "grf07_performed_edges"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {FLAGSHIP: performed.performed_edges}
ORACLE_SQL: dict[str, str] = {FLAGSHIP: performed.PERFORMED_SQL}

for _module in (relational, textual, payloads, graphs, logs, stores, serving, network, people, linking):
    QUERIES |= _module.QUERIES
    ORACLE_SQL |= _module.ORACLE_SQL
