"""Distinct states of stored ranges, so that reports re-read changed ranges only.

A state holds, per range of revisions, the distinct combinations of the columns that
reports count distinct values of.  Such states are exact and mergeable: the reports of
``plans.reports`` that count distinct values give the same rows over the states
of all ranges as over the commits, without the joins and without most of the rows.
"""

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from revlens import schema
from revlens.plans import reports
from revlens.session import discard, materialize, scratch_dir
from revlens.sources.listing import list_files
from revlens.sources.store import BUCKET, CommitStore

LABELS = ("branch", "product_version", "full_version", "year", "month", "week", "author")
#: Columns of each state.
STATES = {"commit_state": LABELS, "issue_state": (*LABELS, "type", "reference")}
#: Stored tables that states are derived from.
SOURCES = ("commits", "date_time", "version", "issues")
MARKS = "state_marks"
_MARK_SCHEMA = "rev_bucket long, mark long"


def _marks_of_files(store: CommitStore) -> dict[int, int]:
    """A mark per range from the names and sizes of its files, which are listed by tasks.

    Spark never writes two files of one name, so a mark changes with any file.
    """
    number = F.regexp_extract("path", rf"/{BUCKET}=(-?\d+)/[^/]+$", 1)
    listed = None
    for table in SOURCES:
        if store.buckets(table):
            files = list_files(store.spark, store.path(table), "*.parquet").filter(~F.contains("path", F.lit("/_temporary/")))
            files = files.select(number.try_cast("bigint").alias(BUCKET), F.xxhash64("path", "length").alias("file"))
            listed = files if listed is None else listed.unionAll(files)
    if listed is None:
        return {}
    marks = listed.filter(F.col(BUCKET).isNotNull()).groupBy(BUCKET).agg(F.bit_xor("file").alias("mark"))
    return {row[0]: row[1] for row in marks.collect()}


def _stored_marks(store: CommitStore) -> dict[int, int]:
    try:
        return {r[0]: r[1] for r in store.spark.read.schema(_MARK_SCHEMA).parquet(store.path(MARKS)).collect()}
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return {}


def _replace(store: CommitStore, state: str, rows: DataFrame, ranges: list[int], scratch: str) -> None:
    """Put the rows of some ranges in the place of the stored ones; a range without rows loses its folder."""
    distinct = materialize(rows.select(BUCKET, *STATES[state]).distinct().hint("rebalance", F.col(BUCKET)), state, below=scratch)
    filled = {row[0] for row in distinct.select(BUCKET).distinct().collect()}
    if filled:
        (
            distinct.sortWithinPartitions(BUCKET)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(BUCKET)
            .parquet(store.path(state))
        )
    for number in set(ranges) - filled:
        discard(store.spark, f"{store.path(state)}/{BUCKET}={number}")


def refresh(store: CommitStore) -> list[int]:
    """Derive the states of ranges that changed since the last call, and return their numbers.

    What changed is told from file names alone.  Marks are taken before the
    tables are read and written after the states: a refresh that was cut short, or a load
    that ran beside it, is made good by the next one.  The driver holds one mark
    per range, of which a store has some thousand at most.
    """
    now, then = _marks_of_files(store), _stored_marks(store)
    changed = sorted(n for n in now.keys() | then.keys() if now.get(n) != then.get(n))
    if not changed:
        return []
    # As text: a column per number of some thousand ranges takes the driver seconds for each table.
    in_changed = F.expr(f"{BUCKET} IN ({', '.join(map(str, changed))})")
    # A store's tables are split alike, so a range joins with itself only.
    tables = {name: store.read_buckets(name, keep_bucket=True).filter(in_changed) for name in SOURCES}
    others = {name: df if name == "commits" else df.drop(BUCKET) for name, df in tables.items()}
    scratch = scratch_dir(store.spark, "states")
    _replace(store, "commit_state", reports.stored_commit_facts(others), changed, scratch)
    _replace(store, "issue_state", reports.stored_issue_facts(others), changed, scratch)
    discard(store.spark, scratch)
    marks = store.spark.createDataFrame(sorted(now.items()), _MARK_SCHEMA)
    marks.coalesce(1).write.mode("overwrite").parquet(store.path(MARKS))
    return changed


def read(store: CommitStore, state: str) -> DataFrame:
    """Rows of a state of all ranges, for reports that count distinct values."""
    types = {field.name: field.dataType for table in SOURCES for field in schema.TABLES[table].fields}
    declared = T.StructType([T.StructField(name, types[name]) for name in STATES[state]])
    try:
        stored = store.spark.read.schema(T.StructType([*declared.fields, T.StructField(BUCKET, T.LongType())]))
        return stored.parquet(store.path(state)).drop(BUCKET)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return store.spark.createDataFrame([], declared)
