"""What loads read, shuffle and report; readers that fail loudly and streams that start again."""

from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from revlens import schema, session
from revlens.operators import diffs, tables
from revlens.plans import load
from revlens.sources import readers
from revlens.sources.commit_log import CommitLog, stream_commit_log
from revlens.sources.listing import list_files, write_files
from revlens.sources.store import CommitStore, typed
from revlens.streaming.incremental import append_stream
from tests.test_load_repairs import content, log_of

RULES = "author string, role string, team string, valid_from date, valid_to date, seq int"


def rules_of(spark, team, author="ann"):
    return spark.createDataFrame([(author, "dev", team, None, None, 1)], RULES)


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_relabelling_prunes_folders_while_it_runs(spark, tmp_path, no_broadcast):
    store = CommitStore(spark, str(tmp_path), span=2)
    load.load(log_of(spark, 1, 9), store, author_rules=rules_of(spark, "core"))
    labelled, changed = load.relabelled(store, rules_of(spark, "web"))
    assert "Join [revision" not in plan_of(changed)  # commits are not joined with themselves
    assert "message" not in plan_of(changed)
    touched = session.materialize(changed.filter("rev_bucket in (1, 3)"), "folders")
    rows = load.in_folders(labelled, touched)
    assert "dynamicpruning" in plan_of(rows)
    assert {r.revision for r in rows.collect()} == {2, 3, 6, 7}
    read = [p for p in plan_of(rows).split("\n") if "FileScan parquet" in p and "message" in p]
    assert read and all("dynamicpruningexpression(rev_bucket" in scan for scan in read)


def test_relabelling_rewrites_only_what_changes(spark, tmp_path):
    store = CommitStore(spark, str(tmp_path), span=3)
    load.load(log_of(spark, 1, 9), store, author_rules=rules_of(spark, "core"))
    files = lambda: {r[0] for r in spark.read.parquet(store.path("commits")).select(F.input_file_name()).distinct().collect()}
    before = files()
    assert load.relabel(store, rules_of(spark, "core")) == 0 and files() == before
    late = spark.createDataFrame([("ann", "dev", "core", None, None, 1), ("ann", "dev", "web", datetime(2016, 1, 9).date(), None, 2)], RULES)
    assert load.relabel(store, late) == 2  # revisions 8 and 9 lie in two folders
    assert len(files() & before) == len(before) - 2
    assert [r.team for r in store.read("commits").orderBy("revision").collect()] == ["core"] * 7 + ["web"] * 2


def test_sizes_join_the_log_in_its_one_exchange(spark, no_broadcast):
    log = log_of(spark, 1, 40)
    sizes = spark.createDataFrame([(r, 10 * r) for r in range(1, 60, 3)] + [(4, 7), (None, 5)], schema.DIFF_SIZE)
    laid = diffs.with_sizes(log.nested, sizes, F.expr("revision div 8"))
    assert plan_of(laid).count("Exchange ") == 1 and "Join" not in plan_of(laid)
    found = {r.revision: r.diff_size for r in laid.collect()}
    assert found == {r: 10 * r if r % 3 == 1 else -1 for r in range(1, 41)}
    assert laid.columns == [*log.nested.columns, "diff_size"]


def test_sizes_leave_entries_without_a_revision_alone(spark):
    heads = log_of(spark, 1, 3).nested
    lost = heads.withColumn("revision", F.lit(None).cast("bigint"))
    sizes = spark.createDataFrame([(1, 5)], schema.DIFF_SIZE)
    found = diffs.with_sizes(heads.unionByName(lost), sizes, F.expr("revision div 2"))
    assert sorted((r.revision or 0, r.diff_size) for r in found.collect()) == [(0, -1)] * 3 + [(1, 5), (2, -1), (3, -1)]


def test_the_highest_revision_comes_from_the_highest_folder(spark, tmp_path):
    store = CommitStore(spark, str(tmp_path), span=10)
    assert store.max_revision() is None and store.buckets("commits") == []
    load.load(log_of(spark, 1, 35), store)
    assert store.buckets("commits") == [0, 1, 2, 3] and store.max_revision() == 35
    plan = plan_of(store.read_bucket("commits", 3).agg(F.max("revision")))
    assert "rev_bucket" in plan and "= 3)" in plan.split("PartitionFilters")[1]
    (tmp_path / "commits" / "rev_bucket=7").mkdir()
    assert store.max_revision() == 35  # an empty folder says nothing
    none = store.read_bucket("commits", 1).limit(0).withColumn("rev_bucket", F.lit(9))
    none.coalesce(1).write.mode("append").parquet(store.path("commits") + "/rev_bucket=8")
    assert store.max_revision() == 35
    report = load.load(log_of(spark, 1, 40), store).first()
    assert (report.lines_cnt, report.n_loaded, report.first_revision) == (40, 5, 36)


def test_a_load_reports_what_it_saw(spark, tmp_path):
    store = CommitStore(spark, str(tmp_path))
    at = datetime(2016, 1, 2, tzinfo=timezone.utc)
    path = lambda i, p, k="file", c=None: (i, p, "M", k, c)
    rows = [
        (5, at, "ann", "see ##1234 - AB", [path(1, "/branches/builds/4/a")]),
        (6, at, "ann", "x" * 200_000, [path(1, "/branches/hotfixes/"), path(2, "/trunk/b")]),
        (7, None, "ann", "##1234 - AB", [path(1, "/trunk/b")]),
        (9, at, "bob", None, [path(1, "/trunk/x", "dir", "/y"), path(2, "/trunk/b"), path(3, "/trunk/c")]),
        (None, at, "bob", None, []),
    ]
    log = CommitLog.from_nested(spark.createDataFrame(rows, schema.LOG_ENTRY))
    report = load.load(log, store, load.FORCE_REBUILD, start=1).first().asDict()
    listed = tables.warnings(log.dated).groupBy("warning").count().collect()
    assert report.pop("warnings") == {r.warning: r["count"] for r in listed} and len(listed) >= 4
    assert report == {
        "lines_cnt": 3, "min_rev": 5, "max_rev": 9, "max_min": 4, "n_loaded": 3, "n_rejected": 1, "first_revision": 5,
        "files_of_first": 1, "last_revision": 9, "files_of_last": 3, "diffs_needed": 2, "diffs_skipped": 1,
    }
    again = load.load(log, store, newest=9).first()
    assert again.lines_cnt == 3 and again.n_loaded is None and again.warnings == {}


def test_a_load_of_nothing_reports_nothing(spark, tmp_path):
    store = CommitStore(spark, str(tmp_path))
    empty = CommitLog.from_nested(spark.createDataFrame([], schema.LOG_ENTRY))
    report = load.load(empty, store, load.FORCE_REBUILD).first()
    assert (report.lines_cnt, report.n_loaded, report.first_revision, report.warnings) == (0, 0, None, {})
    sizes = spark.createDataFrame([(1, 5)], schema.DIFF_SIZE)
    assert load.ingest(empty, store, sizes=sizes)["n_loaded"] == 0


def test_a_column_of_another_type_is_refused(spark):
    rows = spark.createDataFrame([("1", "M", "file", "/a")], "revision string, type string, kind string, file string")
    with pytest.raises(TypeError, match="files.revision is string"):
        typed(rows, "files")
    assert typed(rows.withColumn("revision", F.lit(1)), "files").first().revision == 1


# --- readers -----------------------------------------------------------------


def test_files_are_listed_by_tasks(spark, tmp_path, monkeypatch):
    for i in range(30):
        folder = tmp_path / f"{i % 7}" / f"{i % 3}"
        folder.mkdir(parents=True, exist_ok=True)
        (folder / f"{i}.diff").write_bytes(b"x" * i)
        (folder / f"_{i}.diff").write_bytes(b"hidden")
    (tmp_path / "99.diff").write_bytes(b"top")
    sizes = readers.read_diff_sizes(spark, str(tmp_path))
    assert {(r.revision, r.length) for r in sizes.collect()} == {(i, i) for i in range(30)} | {(99, 3)}
    assert sizes.rdd.getNumPartitions() > 7
    deep = list_files(spark, f"file://{tmp_path}", "1*.diff")
    assert deep.count() == 11 and deep.filter("length = 0").count() == 0
    with pytest.raises(Exception, match="not a folder"):
        list_files(spark, str(tmp_path / "99.diff")).collect()


def test_files_written_by_tasks(spark, tmp_path):
    rows = spark.createDataFrame([("a/1.txt", "é"), ("a/b/2.txt", None), ("3.txt", "x" * 10)], "name string, body string")
    assert write_files(rows, str(tmp_path / "out")) == 3
    assert (tmp_path / "out/a/1.txt").read_text() == "é" and (tmp_path / "out/a/b/2.txt").read_bytes() == b""


DOC = "<document><doc_id>{0}</doc_id><reference>#{0} - AB</reference><revisions>a</revisions></document>"


def test_broken_documents_are_rejected_with_their_place(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    good = DOC.format(1)
    parts = ["<documents>\n", good, "\n", DOC.format("two"), "\n<document><doc_id>3</doc_id><a></document>", DOC.format(4), "</documents>\n"]
    (folder / "#1234 - AB.xml").write_text("".join(parts))
    (folder / "#12345 - AB.xml").write_text(f"<documents>é{DOC.format(5)}\n<document><doc_id>6</doc_id><reference>#6")
    (folder / "other.xml").write_text(DOC.format(7) + "<document type='x'>\n<doc_id>8</doc_id>")  # would be XML with a closing tag
    (folder / "whole.xml").write_text(DOC.format(9))
    with pytest.raises(ValueError, match="broken document in .*AB.xml at byte"):
        readers.read_issue_docs(spark, str(folder))
    rejects = str(tmp_path / "rejects")
    docs = readers.read_issue_docs(spark, str(folder), rejects=rejects)
    assert [(r.doc_id, r.reference, r.revisions) for r in docs.orderBy("doc_id").collect()] == [
        (i, f"#{i} - AB", ["a"]) for i in (1, 4, 5, 7, 9)
    ]
    assert docs.schema.simpleString() == schema.ISSUE_DOC.simpleString()
    found = {(r.file.rpartition("/")[2], r.offset, r.reason.split()[0], r.text[:20]) for r in spark.read.parquet(rejects).collect()}
    tail = "<document><doc_id>6<"
    assert found == {
        ("%231234%20-%20AB.xml", len("".join(parts[:2])), "is", "<document><doc_id>tw"),
        ("%231234%20-%20AB.xml", len("".join(parts[:4])), "is", "<document><doc_id>3<"),
        ("%2312345%20-%20AB.xml", len(f"<documents>é{DOC.format(5)}".encode()), "ends", tail),
        ("other.xml", len(DOC.format(7)), "ends", "<document type='x'>\n"),
    }
    assert [r.doc_id for r in readers.read_issue_docs(spark, str(folder), "bug", rejects=str(tmp_path / "more")).collect()] == [5]


def test_a_large_file_of_documents_is_shared_by_tasks(spark, tmp_path):
    body = "".join(DOC.format(i if i % 1000 else "x") + "\n" * (i % 5) for i in range(60_000))
    (tmp_path / "in.xml").write_text(f"<documents>\n{body}</documents>")
    assert (tmp_path / "in.xml").stat().st_size > 5 << 20
    spark.conf.set("spark.sql.files.maxPartitionBytes", "300000")
    try:
        records = readers._issue_doc_records(spark, str(tmp_path / "in.xml"), None, "document")
        assert records.select("block").distinct().count() > 10
        rejects = {r.offset: r.text for r in readers.issue_doc_rejects(records).collect()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert len(rejects) == 60
    text = (tmp_path / "in.xml").read_text()
    for offset, element in rejects.items():
        assert text[offset:].lstrip("\n").removeprefix("<documents>").lstrip("\n").startswith(element)


ENTRY = '<logentry revision="{0}"><author>ann</author><date>2016-01-02T00:00:00.000000Z</date><paths><path kind="file" action="M">/branches/builds/4.{0}.1/a</path></paths><msg>fix #{1} - AB</msg></logentry>'


def test_a_restarted_stream_of_exports_stores_each_revision_once(spark, tmp_path):
    source, checkpoint = tmp_path / "exports", str(tmp_path / "checkpoint")
    source.mkdir()
    store, whole = CommitStore(spark, str(tmp_path / "store")), CommitStore(spark, str(tmp_path / "whole"))

    def export(name, first, last):
        body = "\n".join(ENTRY.format(r, 1000 + r) for r in range(first, last + 1))
        (source / f".{name}").write_text(f"<?xml version='1.0'?>\n<log>\n{body}\n</log>\n")
        (source / f".{name}").rename(source / name)

    def run():
        query = append_stream(stream_commit_log(spark, str(source), max_files=1), store, checkpoint)
        started = query.trigger(availableNow=True).start()
        started.awaitTermination()
        return len([p for p in started.recentProgress if p.numInputRows])

    export("a.xml", 1, 4)
    export("b.xml", 3, 6)
    assert run() == 2  # a file at a time
    assert store.max_revision() == 6
    export("c.xml", 2, 9)
    assert run() == 1 and run() == 0
    from revlens.sources.commit_log import read_commit_log

    load.ingest(CommitLog.from_nested(read_commit_log(spark, str(source)), unique=False), whole)
    assert content(store) == content(whole)
    assert store.read("commits").count() == 9


def test_packed_exports_of_a_stream_are_parsed_by_more_tasks_than_files(spark, tmp_path):
    import gzip

    source, seen = tmp_path / "exports", []
    source.mkdir()
    entries = [ENTRY.format(r, 1000 + r) for r in [*range(1, 41), *range(1, 41)]]
    odd = ["<logentry><msg>no number</msg></logentry>", "<logentry\n   note='>' revision='41'><msg>&lt;logentry revision=\"7\"></msg></logentry>"]
    with gzip.open(source / "a.xml.gz", "wt") as file:
        file.write("<?xml version='1.0'?>\n<log>\n" + "\n".join([*entries, *odd]) + "\n</log>\n")

    def look(batch, _):
        seen.extend(batch.select("revision", "message", F.spark_partition_id().alias("task")).collect())

    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        stream = stream_commit_log(spark, str(source), max_files=1).writeStream.foreachBatch(look)
        stream.option("checkpointLocation", str(tmp_path / "checkpoint")).trigger(availableNow=True).start().awaitTermination()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len({r.task for r in seen}) > 1
    assert sorted(r.revision for r in seen if r.revision) == sorted([*range(1, 41), *range(1, 41), 41])
    assert {r.message for r in seen if r.revision in (None, 41)} == {"no number", '<logentry revision="7">'}
    # repeated entries meet in one task
    assert len({(r.revision, r.task) for r in seen}) == 42


def test_keys_of_stored_rows_are_not_broadcast(spark, tmp_path, monkeypatch):
    """Neither what is planned by the sizes of files nor what is learnt at run time sends them to the driver."""
    store = CommitStore(spark, str(tmp_path / "store"))
    load.ingest(log_of(spark, 1, 5), store)
    plans, append = [], CommitStore.append
    monkeypatch.setattr(CommitStore, "append", lambda self, df, *rest: (plans.append(plan_of(df)), append(self, df, *rest)))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        load.ingest(log_of(spark, 4, 8), store)
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    anti = [plan for plan in plans if "LeftAnti" in plan]
    assert len(anti) > 3 and all("Broadcast" not in plan for plan in anti)
    assert [r.revision for r in store.read("commits").orderBy("revision").collect()] == list(range(1, 9))


def test_the_exported_log_is_packed(spark, tmp_path):
    orders = "o_orderkey long, o_custkey long, o_orderdate timestamp"
    lines = "l_orderkey long, l_linenumber int, l_suppkey long, l_partkey long, l_returnflag string"
    spark.createDataFrame([(i, i, datetime(1998, 1, 2)) for i in range(3)], orders).write.parquet(f"{tmp_path}/orders.parquet")
    spark.createDataFrame([(i // 2, i, i, i, "N") for i in range(4)], lines).write.parquet(f"{tmp_path}/lineitem.parquet")
    from revlens import catalog

    files = [name for name in spark.read.text(catalog._export_xml_log(spark, str(tmp_path))).inputFiles()]
    assert files and all(name.endswith(".gz") for name in files)
    read = catalog.read_commit_log(spark, str(tmp_path)).collect()
    assert sorted((r.revision, r.path is None) for r in read) == [(1, False), (1, False), (2, False), (2, False), (3, True)]


def test_many_folders_are_listed_by_few_tasks(spark, tmp_path):
    n = 40 * spark.sparkContext.defaultParallelism
    for i in range(n):
        (tmp_path / f"d{i}/deep").mkdir(parents=True)
        (tmp_path / f"d{i}/deep/{i}.diff").write_bytes(b"x" * i)
    listed = list_files(spark, str(tmp_path), "*.diff")
    assert 7 < listed.rdd.getNumPartitions() < n / 4
    assert sorted(r.length for r in listed.collect()) == list(range(n))


def flat_log(spark):
    """Entries and paths of which one comes twice, later with other facts."""
    at = datetime(2016, 1, 2, tzinfo=timezone.utc)
    entries = spark.createDataFrame([(r, at, "ann", f"fix #{1000 + r} - AB") for r in range(1, 41)], "revision long, date timestamp, author string, message string")
    paths = [(r, o, f"/trunk/{r}_{o % 2}.java", "M" if o < 3 else "D", "dir" if r % 3 == 0 and o > 2 else "file", "/x") for r in range(1, 40) for o in (1, 2, 3)]
    paths = spark.createDataFrame(paths, "revision long, ordinal int, path string, type string, kind string, copy_path string")
    return CommitLog.from_flat(entries, paths, unique_paths=False)


def test_heads_are_derived_from_the_written_paths(spark, tmp_path, monkeypatch):
    log, store = flat_log(spark), CommitStore(spark, str(tmp_path / "store"), span=10)
    heads, write, sources, written = log.between(1, 39).heads, load.materialize, [], []

    def noted(df, name, **options):
        if name == "heads":
            sources.extend(df.inputFiles())
            written.extend(df.select(*heads.columns).collect())
        return write(df, name, **options)

    monkeypatch.setattr(load, "materialize", noted)
    found = load.ingest(log.between(1, 39), store)
    assert sources and all("/paths/" in name for name in sources)
    assert sorted(written) == sorted(heads.collect())
    assert found["diffs_needed"] == heads.filter(diffs.needs_diff_column()).count() == 39
    assert store.read("files").count() == 78


def test_a_staged_log_has_no_folder_per_range(spark, tmp_path, monkeypatch):
    log, store = flat_log(spark), CommitStore(spark, str(tmp_path / "store"), span=1)
    staged = []
    monkeypatch.setattr(load, "discard", lambda _spark, path: staged.append(path))
    load.ingest(log, store)
    files = spark.read.parquet(f"{staged[0]}/heads").inputFiles() + spark.read.parquet(f"{staged[0]}/paths").inputFiles()
    assert files and not any("rev_bucket=" in name for name in files)
    assert len(store.buckets("commits")) == 40 and store.read("commits").count() == 40


def test_diff_sizes_are_not_broadcast(spark):
    log, sizes = flat_log(spark), spark.createDataFrame([(r, 10 * r) for r in (1, 2, 3)], "revision long, length long")
    refreshed = diffs.refresh(tables.commits(log.heads), log.heads, sizes, 1, 40).select("revision", "diff_size")
    plan = refreshed._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("rightHint=(strategy=merge)") == 2
    assert {r[0]: r[1] for r in refreshed.filter("revision < 4").collect()} == {1: 10, 2: 20, 3: 30}
