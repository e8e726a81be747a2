"""Loads that were cut short, replayed rejects, spans, labels and databases kept apart."""

from datetime import datetime, timezone

import pytest

from revlens import schema
from revlens.operators import tracker
from revlens.plans import load
from revlens.sources.commit_log import CommitLog
from revlens.sources.store import CommitStore


def log_of(spark, first, last, date=True):
    rows = [
        (r, datetime(2016, 1, 1 + r % 28, tzinfo=timezone.utc) if date else None, "ann", f"fix #{1000 + r} - AB",
         [(1, f"/branches/builds/4.{r}.1/a", "M", "file", None), (2, "/trunk/b", "M", "file", None)])
        for r in range(first, last + 1)
    ]
    return CommitLog.from_nested(spark.createDataFrame(rows, schema.LOG_ENTRY))


def content(store):
    return {name: sorted(map(str, df.collect())) for name, df in store.tables().items()}


@pytest.mark.parametrize("failing", list(schema.TABLES))
def test_a_load_cut_short_is_completed(spark, tmp_path, failing, monkeypatch):
    whole = CommitStore(spark, str(tmp_path / "whole"))
    load.load(log_of(spark, 1, 6), whole)
    store = CommitStore(spark, str(tmp_path / "cut"))
    load.load(log_of(spark, 1, 3), store)
    append = CommitStore.append

    def cut(self, df, table, laid_out=False):
        if table == failing:
            raise OSError("lost")
        append(self, df, table, laid_out)

    with monkeypatch.context() as patch:
        patch.setattr(CommitStore, "append", cut)
        with pytest.raises(OSError):
            load.load(log_of(spark, 1, 6), store)
    load.load(log_of(spark, 1, 6), store)
    assert content(store) == content(whole)


def test_rejects_are_stored_once_and_cleared(spark, tmp_path):
    store = CommitStore(spark, str(tmp_path))
    bad = log_of(spark, 1, 1, date=False)
    for _ in range(3):
        load.ingest(bad, store)
    assert spark.read.parquet(store.path("rejects")).count() == 1
    for _ in range(2):
        load.load(bad, store, load.FORCE_REBUILD)
    assert spark.read.parquet(store.path("rejects")).count() == 1
    load.load(log_of(spark, 1, 2), store, load.FORCE_REBUILD)
    assert spark.read.parquet(store.path("rejects")).count() == 0


def test_another_span_is_refused(spark, tmp_path):
    load.load(log_of(spark, 1, 3), CommitStore(spark, str(tmp_path), span=10))
    with pytest.raises(ValueError, match="span of 10"):
        CommitStore(spark, str(tmp_path)).read("commits")
    assert CommitStore(spark, str(tmp_path), span=10).read("commits", 2, 3).count() == 2


def test_a_load_applies_changed_rules_to_all_commits(spark, tmp_path):
    columns = "author string, role string, team string, valid_from date, valid_to date, seq int"
    store = CommitStore(spark, str(tmp_path), span=2)
    for team, last in (("core", 3), ("web", 6)):
        load.load(log_of(spark, 1, last), store, author_rules=spark.createDataFrame([("ann", "dev", team, None, None, 1)], columns))
    assert [r.team for r in store.read("commits").collect()] == ["web"] * 6


def test_databases_are_kept_apart(spark):
    docs = spark.createDataFrame(
        [(1, "features", "#1234 - AB", "f", "U1", ["a"]), (2, "bugs", "#1234 - AB", "b", "U2", ["a", "b"])],
        "doc_id long, db string, reference string, name string, uniq_id string, revisions array<string>",
    )
    for legacy in (False, True):
        assert {(r.db, r.doc_id) for r in tracker.original_document(docs, legacy).collect()} == {("features", 1), ("bugs", 2)}
    issues = spark.createDataFrame([(7, "F", "#1234 - AB")], "revision long, type string, reference string")
    assert "/R/V/U1>" in tracker.issue_links(issues, docs, replica="R", view="V").first().link
    assert "/U2>" in tracker.issue_links(issues, docs, db="bugs").first().link


def test_the_staged_log_goes_after_a_load(spark, tmp_path, monkeypatch):
    staged = tmp_path / "scratch"
    monkeypatch.setattr(load, "scratch_dir", lambda spark, name: str(staged / name))
    discard, seen = load.discard, []
    monkeypatch.setattr(load, "discard", lambda spark, path: (seen.extend(staged.rglob("*.parquet")), discard(spark, path)))
    load.load(log_of(spark, 1, 3), CommitStore(spark, str(tmp_path / "store")))
    assert seen
    assert not list(staged.glob("*"))
    assert CommitStore(spark, str(tmp_path / "store")).read("files").count() == 6


def test_narrow_tables_are_not_cut_like_the_log(spark, tmp_path):
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64k")
    store = CommitStore(spark, str(tmp_path))
    try:
        wide = spark.range(1, 3001).selectExpr(
            "id revision", "timestamp '2016-01-02 00:00:00' date", "'ann' author", "repeat(sha2(string(id), 512), 8) message",
            "array(named_struct('ordinal', 1, 'path', '/branches/builds/4.1.1/' || sha2(string(id), 512), 'type', 'M',"
            " 'kind', 'file', 'copy_path', string(null))) changed_paths",
        )
        load.ingest(CommitLog.from_nested(wide), store)
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    n_files = {name: len(list((tmp_path / name).rglob("*.parquet"))) for name in schema.TABLES}
    assert n_files["commits"] > 2 * n_files["version"] and store.read("version").count() == 3000
