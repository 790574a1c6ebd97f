"""All registered queries."""

from __future__ import annotations

from checks import ingest_checks, io_checks, master_checks, report_checks, stream_checks, sync_checks

_PARTS = [report_checks, ingest_checks, master_checks, sync_checks, io_checks, stream_checks]


def queries():
    return {name: fn for part in _PARTS for name, fn in part.QUERIES.items()}


def oracle_sql():
    return {name: sql for part in _PARTS for name, sql in part.ORACLE.items()}
