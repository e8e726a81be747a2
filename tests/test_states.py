"""Reports over distinct states of stored ranges."""

import glob
import os

import pytest

from revlens import schema
from revlens.plans import load, reports, states
from revlens.sources import store
from revlens.sources.commit_log import CommitLog


@pytest.fixture
def target(spark, tmp_path):
    return store.CommitStore(spark, str(tmp_path / "store"), span=10)


def entries_of(spark, revisions, author="ann"):
    from datetime import datetime, timezone

    rows = [
        (
            r, datetime(2015, 1 + r % 3, 1 + r % 20, tzinfo=timezone.utc), None if r % 7 == 0 else f"{author}{r % 2}",
            f"fix #{1000 + r % 4} - AB and #{10000 + r % 5} - CD" if r % 3 else None,
            [(1, f"/branches/{'builds' if r % 2 else 'hotfixes'}/4.{r % 3}.1/x", "M", "file", None)] if r % 5 else [],
        )
        for r in revisions
    ]
    return CommitLog.from_nested(spark.createDataFrame(rows, schema.LOG_ENTRY))


OVER_COMMITS = (reports.branches_per_week, reports.branches_authors_per_week)
OVER_ISSUES = (
    reports.issues_per_branch_month,
    reports.issues_authors_per_version_month,
    lambda df: reports.issues_per_author_week(df, "ann1"),
)


def agrees(target, rows):
    stored = target.tables()
    commit_state, issue_state = states.read(target, "commit_state"), states.read(target, "issue_state")
    for report in OVER_COMMITS:
        assert rows(report(commit_state)) == rows(report(reports.stored_commit_facts(stored)))
    for report in OVER_ISSUES:
        assert rows(report(issue_state)) == rows(report(reports.stored_issue_facts(stored)))
    return rows(OVER_ISSUES[0](issue_state))


def files(target, state):
    return {name for name in glob.glob(target.path(state) + "/*/*.parquet")}


def test_only_changed_ranges_are_derived_again(spark, target, rows):
    load.ingest(entries_of(spark, range(1, 38)), target)
    assert states.refresh(target) == [0, 1, 2, 3]
    assert agrees(target, rows)
    before = files(target, "issue_state")
    assert states.refresh(target) == [] and files(target, "issue_state") == before

    load.ingest(entries_of(spark, range(38, 55)), target)
    assert states.refresh(target) == [3, 4, 5]
    agrees(target, rows)
    kept = before & files(target, "issue_state")
    assert {os.path.basename(os.path.dirname(name)) for name in kept} == {f"{store.BUCKET}={n}" for n in (0, 1, 2)}


def test_replaced_and_emptied_ranges(spark, target, rows):
    load.ingest(entries_of(spark, range(1, 40)), target)
    states.refresh(target)
    load.load(entries_of(spark, range(1, 15), author="bob"), target, load.FORCE_REBUILD)
    assert states.refresh(target) == [0, 1, 2, 3]
    agrees(target, rows)
    authors = {r[0] for r in rows(states.read(target, "commit_state"), "author")}
    assert authors == {None, "bob0", "bob1"}
    assert states.refresh(target) == []


def test_a_refresh_cut_short_is_made_good(spark, target, rows, monkeypatch):
    load.ingest(entries_of(spark, range(1, 20)), target)

    def fail(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as patched:
        patched.setattr(reports, "stored_issue_facts", fail)
        with pytest.raises(RuntimeError):
            states.refresh(target)
    assert states.refresh(target) == [0, 1]
    assert agrees(target, rows)


def test_states_of_an_empty_store_and_plan(spark, target, rows):
    assert states.refresh(target) == []
    assert rows(states.read(target, "issue_state")) == []
    load.ingest(entries_of(spark, range(1, 20)), target)
    states.refresh(target)
    report = reports.issues_per_branch_month(states.read(target, "issue_state"))
    assert all("/issue_state/" in name for name in report.inputFiles())
    assert "Join" not in report._jdf.queryExecution().executedPlan().toString()
