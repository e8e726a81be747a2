import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from revlens.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session("revlens-tests", master="local[4]", shuffle_partitions=4)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def folder():
    return "/root/testdata/sf0.001"


def rows(df, *columns):
    """Rows as sorted tuples, nulls first."""
    chosen = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in chosen.collect()), key=lambda r: [(v is not None, str(type(v)), v) for v in r])


@pytest.fixture(name="rows", scope="session")
def rows_fixture():
    return rows


@pytest.fixture(scope="session")
def entries(spark):
    """Four nested log entries with invented authors."""
    from datetime import datetime, timezone

    from revlens import schema

    def at(*parts):
        return datetime(*parts, tzinfo=timezone.utc)

    path = lambda i, p, t, k, c=None: (i, p, t, k, c)
    return spark.createDataFrame(
        [
            (1, at(2015, 1, 3, 23, 30, 15), "ann", "fix #1234 - AB, see #55345 - CD",
             [path(1, "/branches/builds/4.0.1/x.java", "M", "file")]),
            (2, at(2015, 12, 31, 13, 2, 3), "bob", None,
             [path(1, "/branches/hotfixes/4.0.7", "A", "dir", "/trunk")]),
            (3, at(2016, 1, 1), None, "", [path(1, "/trunk/y.DLL", "M", "file")]),
            (4, at(2016, 1, 3, 12), "ann", "none", []),
        ],
        schema.LOG_ENTRY,
    )


@pytest.fixture(scope="session")
def log(entries):
    from revlens.sources.commit_log import CommitLog

    return CommitLog.from_nested(entries)
