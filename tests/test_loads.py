import datetime
import re

import pytest
from pyspark.sql import functions as F

from revlens import schema, session
from revlens.catalog import QUERIES
from revlens.operators import tables
from revlens.plans import load, reports
from revlens.sources import orders_view as V
from revlens.sources import store
from revlens.sources.commit_log import CommitLog
from revlens.streaming.incremental import append_stream


@pytest.fixture
def target(spark, tmp_path):
    return store.CommitStore(spark, str(tmp_path / "store"))


@pytest.fixture(scope="module")
def view(spark, folder):
    """The log over orders, written once so that loads need not derive it again."""
    log = V.commit_log(spark, folder)
    return CommitLog(session.materialize(log.heads, "heads"), session.materialize(log.paths, "paths"))


def contents(target, rows):
    return {name: rows(df) for name, df in target.tables().items()}


def test_an_empty_store_reads_as_empty_tables(target):
    for name, df in target.tables().items():
        assert df.isEmpty() and df.schema.fieldNames() == schema.TABLES[name].fieldNames()


def test_loading_in_parts_equals_loading_at_once(spark, view, target, tmp_path, rows):
    other = store.CommitStore(spark, str(tmp_path / "other"))
    load.ingest(view.between(1, 700), target)
    load.ingest(view.between(500, 1200), target)
    load.ingest(view.between(1000), target)
    load.ingest(view, target)
    load.ingest(view, other)
    parts = contents(target, rows)
    assert parts == contents(other, rows)
    assert parts["commits"] == rows(tables.commits(view.dated).select(*schema.COMMITS.fieldNames()))
    revisions = [r[0] for r in parts["commits"]]
    assert revisions == [r[0] for r in parts["version"]] == [r[0] for r in parts["date_time"]]
    assert sum(r[5] for r in parts["commits"]) == len(parts["files"])


def test_a_load_that_was_cut_short_is_completed(view, target, rows):
    load.ingest(view.between(1, 300), target)
    built = tables.build(view.between(301, 600))
    target.append(built["commits"], "commits")
    target.append(built["issues"], "issues")
    load.ingest(view.between(301, 600), target)
    whole = tables.build(view.between(1, 600))
    assert {n: len(r) for n, r in contents(target, rows).items()} == {n: df.count() for n, df in whole.items()}


def test_loading_nothing_changes_nothing(view, target, rows):
    load.ingest(view.between(1, 20), target)
    load.ingest(view.between(10**9), target)
    assert len(rows(target.read("commits"))) == 20


def test_rejects_are_set_aside(spark, entries, target, rows):
    undated = entries.filter("revision = 1").withColumn("revision", F.lit(50).cast("long")).withColumn("date", F.lit(None).cast("timestamp"))
    load.ingest(CommitLog.from_nested(entries.unionAll(undated)), target)
    assert rows(target.read("commits"), "revision") == [(1,), (2,), (3,), (4,)]
    assert rows(target.read("files"), "revision") == [(1,), (2,), (3,)]
    assert rows(spark.read.parquet(target.path("rejects")), "revision") == [(50,)]


def test_a_range_read_prunes_folders(view, target):
    load.ingest(view.between(1, 50), target)
    plan = target.read("commits", 10, 20)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(rev_bucket" in plan and "GreaterThanOrEqual(revision,10)" in plan


PLANS = [
    # action, loaded, newest, start, end -> status, range
    ("updateOrRebuild", None, 90, 1, None, "load", 1, 90),
    ("updateOrRebuild", 5, 90, 10, None, "load", 10, 90),
    ("updateOrRebuild", 50, 90, 1, None, "load", 51, 90),
    ("updateOrRebuild", 50, 90, 1, 60, "load", 51, 60),
    ("updateOrRebuild", 50, 90, 1, 40, "empty", None, None),
    ("updateOrRebuild", 90, 90, 1, None, "up to date", None, None),
    ("updateOrRebuild", 95, 90, 1, None, "corrupted", None, None),
    ("update", None, 90, 1, None, "load", 1, 90),
    ("update", 50, 90, 1, 60, "load", 51, 60),
    ("update", 90, 90, 1, None, "empty", None, None),
    ("forceRebuild", 50, 90, 1, None, "load", 1, 90),
    ("forceRebuild", 50, 90, 20, 30, "load", 20, 30),
]


def test_load_plans(spark):
    revisions = lambda top: spark.createDataFrame([(r,) for r in (1, top) if top], "revision long")
    for action, db, repo, start, end, *expected in PLANS:
        plan = load.plan_load(revisions(db), revisions(repo), action, start, end).first()
        assert [plan.status, plan.lo, plan.hi] == expected, (action, db, repo, start, end)
    known = load.plan_load(revisions(50), 90, load.UPDATE).first()
    assert known[:] == ("update", 50, 90, "load", 51, 90)
    assert load.plan_load(revisions(None), 90, load.UPDATE).first()[:] == ("update", None, 90, "load", 1, 90)


def test_actions(view, target, rows):
    newest = view.heads.agg(F.max("revision")).first()[0]
    report = lambda *args, **kw: load.load(view, target, *args, **kw).first()[:4]
    assert report(load.UPDATE_OR_REBUILD, 1, 100) == (100, 1, 100, 99)
    assert report(load.UPDATE, end=150) == (150, 1, 150, 149)
    assert report(load.UPDATE_OR_REBUILD, newest=newest) == (newest, 1, newest, newest - 1)
    assert report(load.UPDATE_OR_REBUILD) == (newest, 1, newest, newest - 1)
    assert report(load.FORCE_REBUILD, 11, 20) == (10, 11, 20, 9)
    assert rows(target.read("version"), "revision") == [(r,) for r in range(11, 21)]
    assert rows(load.max_revision(target.read("commits"))) == [(20,)]


def test_labels_and_diff_sizes_are_stored_and_refreshed(spark, entries, target, rows):
    log = CommitLog.from_nested(entries)
    rule = lambda team: spark.createDataFrame([("ann", "dev", team, None, None, 1)], schema.AUTHOR_RULE)
    sizes = spark.createDataFrame([(1, 10), (3, 30)], schema.DIFF_SIZE)
    load.ingest(log, target, rule("core"), sizes)
    shown = lambda: rows(target.read("commits"), "revision", "team", "diff_size")
    assert shown() == [(1, "core", 10), (2, "", -1), (3, "", -1), (4, "core", -1)]
    load.relabel(target, rule("web"))
    bigger = spark.createDataFrame([(1, 11), (4, 44)], schema.DIFF_SIZE)
    report = load.refresh_diffs(log, target, bigger, 1, 2)
    assert report.first()[:] == (4, 1, 4, 3)
    assert shown() == [(1, "web", 11), (2, "", -1), (3, "", -1), (4, "web", -1)]
    load.refresh_diffs(log, target, bigger.filter("revision > 100"))
    assert shown() == [(1, "web", -1), (2, "", -1), (3, "", -1), (4, "web", -1)]


def test_only_touched_ranges_are_rewritten(spark, tmp_path, rows):
    target = store.CommitStore(spark, str(tmp_path / "store"), span=10)
    day = datetime.datetime(2015, 1, 1)
    entries = spark.createDataFrame([(r, day, "ann", "m", []) for r in range(1, 40)], schema.LOG_ENTRY)
    log = CommitLog.from_nested(entries)
    load.ingest(log, target)
    before = {r[0] for r in target.spark.read.parquet(target.path("commits")).select(F.input_file_name()).distinct().collect()}
    load.refresh_diffs(log, target, spark.createDataFrame([], schema.DIFF_SIZE), 12, 18)
    after = {r[0] for r in target.spark.read.parquet(target.path("commits")).select(F.input_file_name()).distinct().collect()}
    assert len(before) == 4 and len(before & after) == 3
    assert len(rows(target.read("commits"))) == 39


def test_stream_stores_every_revision_once(spark, entries, tmp_path, target, rows):
    source, checkpoint = str(tmp_path / "log"), str(tmp_path / "checkpoint")
    spark.createDataFrame([], schema.LOG_ENTRY).write.parquet(source)

    def run():
        stream = spark.readStream.schema(schema.LOG_ENTRY).option("maxFilesPerTrigger", 1).parquet(source)
        append_stream(stream, target, checkpoint).trigger(availableNow=True).start().awaitTermination()

    entries.filter("revision <= 2").unionAll(entries.filter("revision = 2")).coalesce(1).write.mode("append").parquet(source)
    run()
    assert rows(target.read("commits"), "revision") == [(1,), (2,)]
    entries.filter("revision >= 2").coalesce(1).write.mode("append").parquet(source)
    run()
    run()
    at_once = tables.build(CommitLog.from_nested(entries))
    assert contents(target, rows) == {n: rows(df.select(*schema.TABLES[n].fieldNames())) for n, df in at_once.items()}


# --- reports over stored tables ----------------------------------------------


def test_reports_agree_over_log_and_tables(view, target, rows):
    load.ingest(view, target)
    stored = target.tables()
    facts, issue_rows = reports.commit_facts(view), reports.issue_facts(view)
    stored_facts, stored_issue_rows = reports.stored_commit_facts(stored), reports.stored_issue_facts(stored)
    for report in (
        reports.commits_per_branch_month, reports.commits_per_version_month, reports.files_per_commit_month,
        reports.branches_per_week, reports.branches_authors_per_week,
    ):
        assert rows(report(stored_facts)) == rows(report(facts))
    for report in (
        reports.prod_commits_with_issues, reports.issues_per_branch_month, reports.issues_authors_per_version_month,
        lambda df: reports.issues_per_author_week(df, "dev7"),
    ):
        assert rows(report(stored_issue_rows)) == rows(report(issue_rows))
    assert rows(reports.boundary_rows(stored["commits"], 1, 10**9), "revision") == [(1,)]


def test_scripts_with_joined_column_names_run(spark, view, rows):
    store.register_tables(tables.build(view), prefix="j_", joined_names=True)
    counted = spark.sql(
        """
        SELECT fullversion, count(1) AS commits_count, year, month, sum(changedfilescount) AS cf
        FROM j_date_time d, j_version v, j_commits c
        WHERE d.revision = v.revision AND c.revision = v.revision AND (branch = 'builds' OR branch = 'hotfix')
        GROUP BY year, month, fullversion
        """
    )
    expected = reports.commits_per_version_month(reports.commit_facts(view))
    assert rows(counted, "fullversion", "commits_count", "year", "month") == rows(expected)


def test_overlapping_exports_are_stored_once(spark, entries, target, rows):
    repeated = entries.unionAll(entries.filter("revision < 3"))
    load.ingest(CommitLog.from_nested(repeated, unique=False), target)
    assert rows(target.read("commits"), "revision") == [(1,), (2,), (3,), (4,)]
    assert rows(target.read("files"), "revision") == [(1,), (2,), (3,)]


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_joins_of_bucketed_tables_do_not_shuffle(spark, entries, rows):
    built = tables.build(CommitLog.from_nested(entries))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        store.create_tables(spark, built, buckets=4, prefix="bucketed_")
        store.create_tables(spark, built, buckets=4, prefix="bucketed_")
        stored = {name: spark.table(f"bucketed_{name}") for name in built}
        joined = reports.stored_issue_facts(stored)
        assert "SortMergeJoin" in plan_of(joined) and "Exchange" not in plan_of(joined)
        assert len(rows(joined, "revision", "reference")) == 2
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        for name in built:
            spark.sql(f"DROP TABLE IF EXISTS bucketed_{name}")


def test_statistics_decide_in_which_order_a_script_joins(spark, folder, rows):
    settings = ("spark.sql.cbo.enabled", "spark.sql.cbo.joinReorder.enabled")
    df = QUERIES["create_tables"](spark, folder)
    text = df._jdf.queryExecution().analyzed().toString()
    names = {name: re.search(rf"log_\w+_{name}\b", text)[0] for name in ("version", "issues", "date_time", "commits")}

    def order():
        again = spark.sql(
            f"""SELECT v.revision, c.message FROM {names["version"]} v, {names["issues"]} i, {names["date_time"]} dt, {names["commits"]} c
            WHERE v.revision = i.revision AND dt.revision = v.revision AND c.revision = v.revision
            AND v.branch = 'hotfix' AND dt.year = 1998 AND dt.month = 2"""
        )
        plan = again._jdf.queryExecution().optimizedPlan().toString()
        read = re.findall(r"Relation \S*?(version|issues|date_time|commits)\[", plan)
        return read, rows(again)

    try:
        written, expected = order()
        for key in settings:
            spark.conf.set(key, "true")
        chosen, found = order()
        assert written == ["version", "issues", "date_time", "commits"]
        assert set(chosen[:2]) == {"version", "date_time"} and found == expected
    finally:
        for key in settings:
            spark.conf.unset(key)
        for name in names.values():
            spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_reports_over_a_log_read_only_what_they_use(spark, folder):
    facts = reports.commit_facts(V.commit_log(spark, folder))
    plan = plan_of(reports.commits_per_branch_month(facts))
    assert plan.count("Join") == 1
    assert "o_custkey" not in plan and "l_returnflag" not in plan
    calendar_only = plan_of(tables.date_time(V.commit_log(spark, folder).dated))
    assert "lineitem" not in calendar_only and "Exchange" not in calendar_only
