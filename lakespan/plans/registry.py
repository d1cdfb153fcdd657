"""Queries for the reference's operators, by name, with the SQL that must give the same rows."""

from __future__ import annotations

from lakespan.plans import reads, writes  # noqa: F401  (writes registers its queries in reads)

QUERIES, ORACLE_SQL = reads.QUERIES, reads.ORACLE_SQL
FLAGSHIP = "scan_table"
