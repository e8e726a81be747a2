import datetime
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from revlens import schema
from revlens.operators import checks, diffs, tables, teams
from revlens.sources.commit_log import CommitLog, flatten_paths


def date(text):
    return datetime.date.fromisoformat(text)


def test_commits(log, rows):
    assert rows(tables.commits(log.dated), "revision", "date", "author", "team", "role", "changed_files_count", "diff_size", "message") == [
        (1, date("2015-01-03"), "ann", "", "", 1, -1, "fix #1234 - AB, see #55345 - CD"),
        (2, date("2015-12-31"), "bob", "", "", 1, -1, ""),
        (3, date("2016-01-01"), None, "", "", 1, -1, ""),
        (4, date("2016-01-03"), "ann", "", "", 0, -1, "none"),
    ]


def test_version(log, rows):
    assert rows(tables.version(log.dated), "revision", "branch", "full_version", "product_version") == [
        (1, "builds", "4.0.1", "4.0"),
        (2, "hotfix", "4.0.7", "4.0"),
        (3, "other", "other", "other"),
        (4, "other", "other", "other"),
    ]


def test_date_time(log, rows):
    shown = rows(tables.date_time(log.dated, extras=True), "revision", "year", "week", "day_of_week", "hour", "hour24", "time", "week_year")
    assert shown == [
        (1, 2015, 1, 7, 11, 23, "23:30:15", 2015),
        (2, 2015, 1, 5, 1, 13, "13:02:03", 2016),
        (3, 2016, 1, 6, 0, 0, "00:00:00", 2016),
        (4, 2016, 2, 1, 0, 12, "12:00:00", 2016),
    ]


def test_calendar_follows_the_session_time_zone(spark, log, rows):
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        assert rows(tables.date_time(log.dated).filter("revision = 1"), "day", "hour", "day_of_week") == [(4, 8, 1)]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_issues(log, rows):
    assert rows(tables.issues(log.dated)) == [
        (1, "B", "#55345 - CD", "", ""),
        (1, "F", "#1234 - AB", "", ""),
    ]


def test_issues_come_from_the_raw_message(spark, rows):
    heads = spark.createDataFrame([(1, "#1234 - AB" + "#" * 1000)], "revision long, message string")
    assert rows(tables.issues(heads), "type", "reference") == [("F", "#1234 - AB")]


def test_files(log, rows):
    assert rows(tables.files(log.paths)) == [
        (1, "M", "file", "/branches/builds/4.0.1/x.java"),
        (2, "A", "dir", "/branches/hotfixes/4.0.7"),
        (3, "M", "file", "/trunk/y.DLL"),
    ]


def test_table_types_are_the_declared_ones(log):
    for name, df in tables.build(log).items():
        assert [(f.name, f.dataType) for f in df.schema] == [(f.name, f.dataType) for f in schema.TABLES[name]]


def test_flat_and_nested_logs_agree(entries, log, rows):
    flat = CommitLog.from_flat(entries.drop("changed_paths"), flatten_paths(entries))
    raw = flatten_paths(entries).unionAll(flatten_paths(entries).withColumn("ordinal", F.col("ordinal") + 9))
    doubled = CommitLog.from_flat(entries.drop("changed_paths"), raw, unique_paths=False)
    assert rows(flat.heads) == rows(log.heads) == rows(doubled.heads)
    assert rows(flat.paths) == rows(log.paths) == rows(doubled.paths)


def test_first_path_is_the_lowest_ordinal_then_path(spark, rows):
    paths = spark.createDataFrame(
        [(1, 2, "/a", "M", "file", None), (1, 1, "/z", "M", "file", None), (1, 1, "/y", "M", "file", None)],
        "revision long, ordinal int, path string, type string, kind string, copy_path string",
    )
    heads = spark.createDataFrame([(1, None, None, None)], "revision long, date timestamp, author string, message string")
    nested = heads.join(
        paths.groupBy("revision").agg(F.collect_list(F.struct("ordinal", "path", "type", "kind", "copy_path")).alias("changed_paths")),
        "revision",
    )
    for log in (CommitLog.from_flat(heads, paths), CommitLog.from_nested(nested)):
        assert rows(log.heads, "first_path", "changed_files_count") == [("/y", 3)]


def test_entries_without_a_date_are_rejected(spark, rows):
    nested = spark.createDataFrame([(1, None, "ann", "m", [])], schema.LOG_ENTRY)
    log = CommitLog.from_nested(nested)
    assert rows(log.dated) == [] and rows(log.rejects, "revision") == [(1,)]


def test_warnings(spark, rows):
    heads = spark.createDataFrame(
        [
            (1, "a" * 102400, None),
            (2, "#" * 1000, "/branches/builds/4.1/x"),
            (3, "see ##1234 - AB", "/branches/hotfixes/main/x"),
            (4, None, "/branches/builds/"),
            (5, "#1234 - AB ##12345 - AB", "/trunk/x"),
        ],
        "revision long, message string, first_path string",
    )
    assert rows(tables.warnings(heads)) == [
        (1, "message is too long", "102400"),
        (2, "message contains too many issues", "1000"),
        (3, "full version is too short", "main"),
        (3, "reference has a doubled mark", "##1234 - AB"),
        (4, "path holds no version", "/branches/builds/"),
    ]


# --- diff policy -------------------------------------------------------------


@pytest.fixture(scope="module")
def sizes(spark):
    return spark.createDataFrame([(1, 10), (3, 30)], schema.DIFF_SIZE)


def test_diff_need_and_lists(log, sizes, rows):
    assert rows(diffs.needs_diff(log.heads)) == [(1, True), (2, False), (3, False), (4, False)]
    assert rows(diffs.worklist(log.heads, sizes)) == []
    assert rows(diffs.worklist(log.heads, sizes.filter("revision = 3"))) == [(1,)]
    assert rows(diffs.obsolete(log.heads, sizes)) == [(3, 30)]
    assert rows(diffs.progress(log.heads)) == [(4, 1, 3)]


def test_diff_sizes(log, sizes, rows):
    commits = tables.commits(log.dated)
    sized = lambda df: [size for _, size in rows(df, "revision", "diff_size")]
    assert sized(diffs.update_sizes(commits, sizes, 1, 4)) == [10, -1, 30, -1]
    assert sized(diffs.refresh(commits, log.heads, sizes, 1, 4)) == [10, -1, -1, -1]
    earlier = commits.withColumn("diff_size", F.lit(7).cast("bigint"))
    assert sized(diffs.update_sizes(earlier, sizes, 2, 3)) == [7, -1, 30, 7]


def test_mixed_paths_need_a_diff_unless_a_directory_was_copied(spark, rows):
    skipped, changed = (1, "/a.log", "M", "file", None), (2, "/a.java", "M", "file", None)
    deleted, copied = (3, "/b.java", "D", "file", None), (4, "/c", "A", "dir", "/trunk")
    cases = [[skipped], [skipped, changed], [deleted], [changed, copied], [changed, (5, "/d", "A", "dir", "")]]
    nested = spark.createDataFrame([(i, None, None, None, c) for i, c in enumerate(cases)], schema.LOG_ENTRY)
    expected = [(0, False), (1, True), (2, False), (3, False), (4, True)]
    assert rows(diffs.needs_diff(CommitLog.from_nested(nested).heads)) == expected
    flat = CommitLog.from_flat(nested.drop("changed_paths"), flatten_paths(nested))
    assert rows(diffs.needs_diff(flat.heads)) == expected


def test_watchlist(spark, log, rows):
    listed = spark.createDataFrame([(4,), (1,), (1,), (99,)], "revision long")
    shown = rows(diffs.watchlist(log.heads, log.paths, listed))
    assert shown == [(1, True, "M", "file", "/branches/builds/4.0.1/x.java"), (4, False, None, None, None)]
    assert len(rows(diffs.watchlist(log.heads, log.paths, listed, limit=1))) == 1


# --- teams -------------------------------------------------------------------


@pytest.fixture(scope="module")
def author_rules(spark):
    day = datetime.date(2016, 1, 1)
    return spark.createDataFrame(
        [("ann", "dev", "core", None, day, 1), ("ann", "dev", "web", day, None, 2), ("bob", "qa", "web", None, None, 3)],
        schema.AUTHOR_RULE,
    )


def test_teams(log, author_rules, rows):
    labelled = teams.assign_team_role(tables.commits(log.dated), author_rules)
    assert rows(labelled, "revision", "team", "role") == [(1, "core", "dev"), (2, "web", "qa"), (3, "", ""), (4, "web", "dev")]


def test_later_rules_overwrite_earlier_ones(spark, rows):
    """Every date of a year against rules applied one after the other."""
    import random

    dice = random.Random(7)
    first = datetime.date(2020, 1, 1)
    day = lambda: first + datetime.timedelta(days=dice.randrange(365))
    table = []
    for seq in range(30):
        lo, hi = sorted((day(), day()))
        lo, hi = dice.choice([(None, hi), (lo, None), (lo, hi), (lo, hi), (None, None) if seq < 3 else (lo, None)])
        table.append((dice.choice("ab"), "dev", f"t{seq}", lo, hi, seq))
    commits = [(i, first + datetime.timedelta(days=i % 365), "ab"[i // 365], "", "") for i in range(730)]
    expected = []
    for revision, when, author, team, _ in commits:
        for who, _, name, lo, hi, _ in table:
            if who == author and (lo is None or when >= lo) and (hi is None or when < hi):
                team = name
        expected.append((revision, team))
    df = spark.createDataFrame(commits, "revision long, date date, author string, team string, role string")
    labelled = teams.assign_team_role(df, spark.createDataFrame(table, schema.AUTHOR_RULE))
    assert rows(labelled, "revision", "team") == expected


def test_large_rule_tables_are_not_broadcast(spark, log, author_rules, rows, monkeypatch):
    from revlens import session

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        monkeypatch.setattr(teams, "broadcast_if_small", lambda df: session.broadcast_if_small(df, rows=1))
        labelled = teams.assign_team_role(tables.commits(log.dated), author_rules)
        assert "Broadcast" not in labelled._jdf.queryExecution().executedPlan().toString()
        assert rows(labelled, "revision", "team") == [(1, "core"), (2, "web"), (3, ""), (4, "web")]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


# --- checks ------------------------------------------------------------------


@pytest.mark.parametrize("bitmaps", [1, checks.BITMAPS])
def test_only_suspect_keys_are_grouped(spark, rows, bitmaps):
    draw = random.Random(bitmaps)
    keys = [(n, f"/{n}") for n in range(3000)] + [(draw.randrange(60), draw.choice(["/a", "/b", None])) for _ in range(400)]
    keys += [(None, "/c"), (None, "/c"), (None, None), (7, "/hot")] + [(8, "/hot")] * 1000
    files = spark.createDataFrame([(r, "M", "file", f) for r, f in keys], schema.FILES)
    expected = sorted(((k, n) for k, n in Counter(keys).items() if n > 1), key=repr)
    found = checks.unique_violations(files, ["revision", "file"], bitmaps)
    assert sorted((((r, f), n) for r, f, n in rows(found)), key=repr) == expected
    n_suspects = checks.suspects(files, ["revision", "file"], bitmaps).count()
    n_repeated = sum(n for _, n in expected)
    assert n_repeated <= n_suspects < n_repeated + (100 if bitmaps == 1 else 5)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_keys_of_empty_tables_and_of_numbers(spark, rows):
    empty = spark.createDataFrame([], schema.FILES)
    assert rows(checks.unique_violations(empty, ["revision", "file"])) == []
    assert rows(checks.table_violations({"files": empty})) == [("files", 0, 0)]
    numbers = checks.unique_violations(spark.range(3).union(spark.range(1)), ["id"])
    assert rows(numbers) == [(0, 2)] and "Join" not in numbers._jdf.queryExecution().executedPlan().toString()


def test_checks(spark, rows):
    files = spark.createDataFrame(
        [(1, "M", "file", "/a"), (1, "A", "file", "/a"), (2, "M", "file", "/" + "b" * 2048)], schema.FILES
    )
    assert rows(checks.unique_violations(files, ["revision", "file"])) == [(1, "/a", 2)]
    assert rows(checks.length_violations(files, schema.TEXT_LIMITS["files"])) == [(2, "file", 2049, 2048)]
    assert rows(checks.table_violations({"files": files})) == [("files", 1, 1)]
