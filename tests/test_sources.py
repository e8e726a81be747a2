import datetime

import pytest
from pyspark.sql import functions as F

from revlens import schema, session
from revlens.plans import jobs
from revlens.sources import readers, store
from revlens.sources.commit_log import CommitLog, read_commit_log, revision_range

XML = """<?xml version="1.0" encoding="UTF-8"?>
<log>
<logentry
   revision="3">
<author>ann</author>
<date>2015-01-03T23:30:15.123456Z</date>
<paths>
<path
   prop-mods="false" text-mods="true" kind="file"
   action="M">/branches/builds/4.0.1/x &amp; y.java</path>
<path copyfrom-rev="2" copyfrom-path="/trunk" action="A" kind="dir">/branches/b</path>
</paths>
<msg>fix #1234 - AB,
 see &lt;/logentry&gt; </msg>
</logentry>
<logentry revision="4">
<date>2015-01-04T00:00:00.000000Z</date>
<msg></msg>
</logentry>
</log>
"""


def test_xml_log(spark, tmp_path):
    (tmp_path / "a.xml").write_text(XML)
    (tmp_path / "b.xml").write_text('<log><logentry revision="5"><author>bob</author></logentry></log>')
    nested = read_commit_log(spark, str(tmp_path))
    found = nested.withColumn("date", F.date_format("date", "yyyy-MM-dd HH:mm:ss.SSSSSS")).orderBy("revision").collect()
    assert [r.revision for r in found] == [3, 4, 5]
    assert found[0].date == "2015-01-03 23:30:15.123456"
    assert found[0].message == "fix #1234 - AB,\n see </logentry> "
    assert [tuple(p) for p in found[0].changed_paths] == [
        (1, "/branches/builds/4.0.1/x & y.java", "M", "file", None),
        (2, "/branches/b", "A", "dir", "/trunk"),
    ]
    assert (found[1].author, found[1].changed_paths, found[2].date) == (None, [], None)
    assert nested.schema.simpleString() == schema.LOG_ENTRY.simpleString()
    log = CommitLog.from_nested(nested)
    assert [tuple(r) for r in log.heads.orderBy("revision").select("changed_files_count", "has_copied_dir", "has_diffable").collect()] == [
        (2, True, True), (0, False, False), (0, False, False)]


def test_one_large_xml_file_is_shared_by_tasks(spark, tmp_path):
    entry = '<logentry revision="{0}"><msg>number {0} &lt;{1}&gt;</msg></logentry>\n'
    body = "".join(entry.format(i, "x" * 200) for i in range(5000))
    (tmp_path / "log.xml").write_text(f"<?xml version='1.0'?>\n<log>\n{body}</log>\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "100000")
    try:
        log = read_commit_log(spark, str(tmp_path))
        assert log.rdd.getNumPartitions() > 4
        assert log.agg(F.count("*"), F.sum("revision"), F.count("message")).first()[:] == (5000, 12497500, 5000)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_json_log_and_range(spark, entries, tmp_path, rows):
    entries.write.json(str(tmp_path / "log"))
    back = read_commit_log(spark, str(tmp_path / "log"), format="json")
    assert rows(back, "revision", "author") == rows(entries, "revision", "author")
    assert rows(revision_range(back, 2, 3), "revision") == [(2,), (3,)]
    assert rows(revision_range(back, 3), "revision") == [(3,), (4,)]


def test_diff_listing_does_not_read_contents(spark, tmp_path, rows):
    (tmp_path / "deep").mkdir()
    for name, size in (("1.diff", 10), ("deep/12.diff", 0), ("7.diff.obsolete", 3), ("x.diff", 4), ("3.txt", 5)):
        (tmp_path / name).write_bytes(b"x" * size)
    sizes = readers.read_diff_sizes(spark, str(tmp_path))
    assert rows(sizes) == [(1, 10), (12, 0)]
    assert "content" not in sizes._jdf.queryExecution().executedPlan().toString()


def test_author_rules_file(spark, tmp_path, rows):
    (tmp_path / "rules.csv").write_text(
        "author,role,team,valid_from,valid_to,seq\nann,dev,core,,01.02.2015,1\nann,dev,web,01.02.2015,,2\n"
    )
    day = datetime.date(2015, 2, 1)
    assert rows(readers.read_author_rules(spark, str(tmp_path))) == [
        ("ann", "dev", "core", None, day, 1), ("ann", "dev", "web", day, None, 2)]


def test_issue_docs_are_chosen_by_file_name(spark, tmp_path, rows):
    doc = "<document><doc_id>{0}</doc_id><reference>{1}</reference><revisions>a</revisions><revisions>b</revisions></document>"
    for i, name in enumerate(("#1234 - AB.xml", "#12345 - AB.XML", "#123 - AB.xml", "#1234 - AB.txt", "+1234 + A+.xml")):
        (tmp_path / name).write_text(doc.format(i, name[:-4]))
    read = lambda kind: rows(readers.read_issue_docs(spark, str(tmp_path), kind), "doc_id", "reference", "revisions")
    assert read("feature") == [(0, "#1234 - AB", ["a", "b"]), (4, "+1234 + A+", ["a", "b"])]
    assert read("bug") == [(1, "#12345 - AB", ["a", "b"])]
    assert len(read(None)) == 5


@pytest.mark.parametrize("split", ["64", "1000", "134217728"])
def test_build_log_lines_are_numbered_across_splits(spark, tmp_path, rows, split):
    import random

    dice = random.Random(3)
    expected = []
    for name in ("a.log", "b.log", "c.log"):
        lines = [dice.choice(["", "  \t", "x" * dice.randrange(1, 90), f"line {i}"]) for i in range(400)]
        (tmp_path / name).write_text("\n".join(lines) + dice.choice(["", "\n"]))
        expected += [(name, i + 1, line) for i, line in enumerate(lines) if line.strip()]
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    spark.conf.set("spark.sql.files.openCostInBytes", "10")
    try:
        found = readers.read_build_log(spark, str(tmp_path))
        name = F.substring_index("file", "/", -1).alias("name")
        assert rows(found, name, "line_no", "line") == sorted(expected)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_tsv_holds_values_as_they_are(spark, tmp_path):
    df = spark.createDataFrame([(1, 'say "hi", \\', None, "")], "a int, b string, c string, d string")
    store.write_tsv(df, str(tmp_path / "out"))
    assert [r[0] for r in spark.read.text(str(tmp_path / "out")).collect()] == ['1\tsay "hi", \\\t\t']


def test_scratch_folder_comes_from_the_session(spark):
    path = session.scratch_dir(spark, "x")
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    assert path.startswith(root.rstrip("/") + "/x-") and path != session.scratch_dir(spark, "x")


# --- build logs and histories ------------------------------------------------

LINES = [
    r"***** s:\src\cpp\p1 *****", "error A", "Stop.",
    r"***** s:\src\cpp\p2 *****", "OK",
    r"***** s:\src\cpp\p3 *****", "error A",
]


@pytest.mark.parametrize("chunk", [2, 3, 65536])
def test_build_errors(spark, rows, chunk):
    lines = spark.createDataFrame([("f", i + 1, line) for i, line in enumerate(LINES)], schema.BUILD_LINE)
    pairs = lambda **kw: rows(jobs.build_errors(lines, chunk_lines=chunk, **kw), "error_line", "project")
    assert pairs() == [("error A", "p1"), ("error A", "p3")]
    assert pairs(legacy=True) == [("error A", "p1")]


@pytest.mark.parametrize("chunk", [1, 7, 65536])
def test_blocks_match_a_sequential_reading(spark, rows, chunk):
    import random

    dice = random.Random(11)
    pool = ["***** s:\\src\\cpp\\p%d *****", " ***** S:\\src\\cpp\\q%d *****", "*****", "error %d", "OK, done %d", " stop. ", "Stop."]
    data, expected = [], []
    for file in ("f", "g", "h"):
        blocks, number = [[]], 0
        for _ in range(300):
            number += dice.randrange(1, 4)
            line = dice.choice(pool)
            line = line % dice.randrange(5) if "%" in line else line
            data.append((file, number, line))
            if line.strip().upper().startswith("***** "):
                blocks.append([])
            blocks[-1].append(line)
        for block in blocks:
            if len(block) < 2 or block[-1].strip().startswith("OK"):
                continue
            error = block[-2] if block[-1].strip().upper() == "STOP." else block[-1]
            expected.append((error, block[0][17:max(len(block[0]) - 6, 17)], file))
    lines = spark.createDataFrame(data, schema.BUILD_LINE)
    assert rows(jobs.build_errors(lines, chunk_lines=chunk), "error_line", "project", "file") == sorted(expected)


@pytest.mark.parametrize("split", ["1000", "134217728"])
def test_blocks_of_split_files_match_numbered_lines(spark, rows, tmp_path, split):
    import random

    dice = random.Random(7)
    pool = ["***** s:\\src\\cpp\\p%d *****", " ***** S:\\src\\cpp\\q%d *****", "*****", "", " \t", "error %d é", "OK, done %d", " stop. ", "Stop.", "x" * 90]
    for name, n, kinds in (("a", 300, pool), ("b", 120, pool[2:]), ("c", 1, pool[:1]), ("d", 200, pool[:2]), ("e", 0, pool), ("f", 9, pool[3:5])):
        lines = [dice.choice(kinds) for _ in range(n)]
        text = "\n".join(line % dice.randrange(5) if "%" in line else line for line in lines)
        (tmp_path / f"{name}.log").write_text(text + dice.choice(["", "\n"]))
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    spark.conf.set("spark.sql.files.openCostInBytes", "10")
    try:
        path = str(tmp_path)
        columns = "file", "block", "n_lines", "header", "status", "error_line", "project", "is_last"
        expected = rows(jobs.build_blocks(readers.read_build_log(spark, path)), *columns)
        assert len(expected) > 100 and {r[4] for r in expected} == {"rejected", "ok", "error"}
        assert rows(jobs.build_blocks_of_files(spark, path), *columns) == expected
        errors = rows(jobs.build_errors_of_files(spark, path, legacy=True), "error_line", "project", "file", "block")
        assert errors == sorted((r[5], r[6], r[0], r[1]) for r in expected if r[4] == "error" and not r[7])
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_blocks_of_files_move_no_line(spark, tmp_path):
    (tmp_path / "a.log").write_text("\n".join(LINES))
    plan = jobs.block_pieces(spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Sort" not in plan
    # of 600 lines in 3 blocks the pieces are what is written
    body = "\n".join(f"{LINES[0]}\n" + "\n".join(f"step {k}" for k in range(199)) for _ in range(3))
    (tmp_path / "a.log").write_text(body)
    assert jobs.block_pieces(spark, str(tmp_path)).count() == 3


def test_statuses(spark, rows):
    lines = [
        "12/08/2013 - Fixedby x", "12/08/2013 - More info requested by x", "12/08/2013 - Case closed by x",
        "12/08/2013 - Status Changed to NEW by x", "short", "", "12/08/2013 - x says the bug is not fixed yet",
    ]
    docs = spark.createDataFrame([(1, "\n".join(lines) + "\n\n"), (2, None), (3, ""), (4, "\n")], "doc_id long, history string")
    found = jobs.history_lines(docs)
    shown = lambda fixed: dict(rows(found, "message", jobs.status_of_message(F.col("message"), fixed)))
    expected = {
        "Fixedby x": "FIXED", "More info requested by x": "QUESTION", "Case closed by x": "DONE",
        "Status Changed to NEW by x": "", "short": "UNKNOWN", "": "UNKNOWN", "x says the bug is not fixed yet": "NEW",
    }
    assert shown(False) == expected
    assert shown(True) == {**expected, "Status Changed to NEW by x": "NEW"}
    assert rows(jobs.history_messages(docs)) == [("",), ("short",)]
    assert rows(jobs.history_messages(docs, max_docs=0)) == []


def test_bug_to_feature(spark, rows):
    docs = spark.createDataFrame(
        [(1, "#1", "#1234 - AB title"), (2, "", "x"), (3, "#3", ""), (4, None, ""), (5, "#5", "one two")],
        "doc_id long, reference string, feature string",
    )
    assert rows(jobs.bug_to_feature(docs)) == [
        (1, "#1", "#1234 - AB", "#1234 - AB title"), (3, "#3", "", ""), (5, "#5", None, "one two")]
    assert rows(jobs.bug_to_feature(docs, newest=1), "doc_id") == [(5,)]
