import os

import pytest

from checks.compare import duck
from daybook.session import session

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    s = session("tests", "local[4]", spark__sql__shuffle__partitions="4",
                spark__ui__enabled="false", spark__driver__memory="4g")
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def folder():
    return FOLDER


@pytest.fixture(scope="session")
def con(folder):
    return duck(folder)


@pytest.fixture
def rows(spark):
    """A DataFrame from dicts, missing fields defaulted, in the schema of a table."""
    from daybook.plans.books import conform
    from daybook.schema import TABLES

    def build(table, *records, incremental=False):
        from pyspark.sql import types as T
        from daybook.schema import incremental_columns
        t = TABLES[table]
        kinds = dict(incremental_columns(t)) if incremental else {c: t.type(c) for c in t.columns}
        used = sorted({c for r in records for c in r}) or [t.columns[0]]
        ddl = ", ".join(f"`{c}` {'string' if kinds[c] != 'string' else kinds[c]}" for c in used)
        text = [[None if r.get(c) is None else str(r[c]) for c in used] for r in records]
        raw = spark.createDataFrame(text, T.StructType.fromDDL(ddl))
        return conform(raw, t, incremental)

    return build
