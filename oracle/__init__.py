"""Independent SQL for checking the operators; plain text, run by DuckDB."""

from oracle import analytics, records, summaries

ORACLE = {**analytics.QUERIES, **summaries.QUERIES, **records.QUERIES}
