"""The commit log: exported XML, JSON or parquet in, entries and paths out."""

import re
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from revlens import schema
from revlens.functions import paths as P

_XML_PATH = T.StructType(
    [
        T.StructField("_VALUE", T.StringType()),
        T.StructField("_action", T.StringType()),
        T.StructField("_kind", T.StringType()),
        T.StructField("_copyfrom-path", T.StringType()),
    ]
)
XML_ENTRY = T.StructType(
    [
        T.StructField("_revision", T.LongType()),
        T.StructField("author", T.StringType()),
        T.StructField("date", T.TimestampType()),
        T.StructField("paths", T.StructType([T.StructField("path", T.ArrayType(_XML_PATH))])),
        T.StructField("msg", T.StringType()),
    ]
)


def read_commit_log(spark: SparkSession, path: str, format="xml", row_tag="logentry") -> DataFrame:
    """Log entries with their changed paths, one row per entry.

    ``xml`` reads what the version-control client exports with paths switched
    on, in UTF-8; ``json`` and ``parquet`` read entries already in the nested
    schema.  XML is read as text that ends a record at each closing tag, since
    the XML source gives a whole file to one task and an export is often a
    single file.  Character data cannot contain the tag: exports escape it.
    """
    if format != "xml":
        return spark.read.format(format).schema(schema.LOG_ENTRY).load(path)
    closing = f"</{row_tag}>"
    return _entries(spark.read.text(path, lineSep=closing), row_tag)


def stream_commit_log(
    spark: SparkSession, path: str, row_tag="logentry", max_files: int | None = None
) -> DataFrame:
    """A stream of the entries of exported XML files in a folder, files as they arrive.

    It reads files as ``read_commit_log`` does.  ``max_files`` bounds the files of a micro-batch, so
    that a folder full of old exports is worked off in bounded steps; a packed file is unpacked by
    one task, so those few files are dealt out as text and parsed by all.  Files count as a whole:
    they must appear complete, by a rename, as Spark's file streams ask for.
    """
    reader = spark.readStream.option("lineSep", f"</{row_tag}>")
    if max_files is None:
        return _entries(reader.text(path), row_tag)
    return _entries(reader.option("maxFilesPerTrigger", max_files).text(path), row_tag, deal=True)


def _entries(texts: DataFrame, row_tag: str, deal=False) -> DataFrame:
    """Log entries from text that ends a record at each closing tag; ``deal`` parses in other tasks than those that read."""
    opening = F.instr("value", f"<{row_tag}")
    element = F.concat(F.substr("value", opening), F.lit(f"</{row_tag}>"))
    options = {"ignoreSurroundingSpaces": "false", "mode": "FAILFAST"}
    kept = texts.filter(opening > 0)
    raw = (
        (_dealt(kept, row_tag) if deal else kept)
        .select(F.from_xml(element, XML_ENTRY, options).alias("entry"))
        .select("entry.*")
    )
    return raw.select(
        F.col("_revision").alias("revision"),
        "date",
        "author",
        F.col("msg").alias("message"),
        F.transform(
            F.coalesce(F.col("paths.path"), F.array().cast(T.ArrayType(_XML_PATH))),
            lambda p, i: F.struct(
                (i + 1).alias("ordinal"),
                p["_VALUE"].alias("path"),
                p["_action"].alias("type"),
                p["_kind"].alias("kind"),
                p["_copyfrom-path"].alias("copy_path"),
            ),
        ).alias("changed_paths"),
    )


def _dealt(texts: DataFrame, row_tag: str) -> DataFrame:
    """The texts of entries dealt out to tasks, those of a revision together unless they are very many.

    Repeated entries then meet before they are shuffled again.  The revision is only looked for to
    place a text: one in which it is not found goes by its whole content.
    """
    number = F.regexp_extract("value", rf"""<{re.escape(row_tag)}\s[^>]*?\brevision\s*=\s*["'](\d+)""", 1)
    place = F.xxhash64(F.when(number != "", number).otherwise(F.col("value")))
    return texts.withColumn("place", place).hint("rebalance", "place")


def revision_range(df: DataFrame, start: int = 1, end: int | None = None) -> DataFrame:
    """Rows from ``start`` to ``end``, both included; no end means the newest."""
    kept = F.col("revision") >= start
    return df.filter(kept if end is None else kept & (F.col("revision") <= end))


def flatten_paths(nested: DataFrame) -> DataFrame:
    """One row per changed path; entries without paths give none."""
    return nested.select("revision", F.explode("changed_paths").alias("p")).select("revision", "p.*")


def dedupe_paths(paths: DataFrame) -> DataFrame:
    """Keep the lowest ordinal of every (revision, path)."""
    first = F.min(F.struct("ordinal", "type", "kind", "copy_path")).alias("first")
    return paths.groupBy("revision", "path").agg(first).select("revision", "path", "first.*")


@dataclass(frozen=True)
class CommitLog:
    """A log as two views that every table and check is derived from.

    ``heads`` has one row per commit with its first path, number of paths and
    the two facts the diff policy needs.  ``paths`` has one row per changed path.
    ``nested``, if the log has that form, is the heads with their paths in an
    array, which yields both views in one pass.  ``entries``, if heads are derived
    from them and the paths, lets heads be derived again from a copy of the paths.
    """

    heads: DataFrame
    paths: DataFrame
    nested: DataFrame | None = None
    entries: DataFrame | None = None
    mode: str = "suffix"

    @classmethod
    def from_nested(cls, nested: DataFrame, unique=True, mode="suffix") -> "CommitLog":
        """From entries that hold their paths in an array: no shuffle at all.

        Paths compare by ordinal, then path, so the first one is their minimum.
        Overlapping exports repeat entries; ``unique=False`` keeps one of each.
        """
        if not unique:
            nested = nested.dropDuplicates(["revision"])
        arr = F.coalesce(F.col("changed_paths"), F.array().cast(T.ArrayType(schema.CHANGED_PATH)))
        described = nested.select(
            "revision",
            "date",
            "author",
            "message",
            F.array_min(arr)["path"].alias("first_path"),
            F.size(arr).alias("changed_files_count"),
            F.exists(arr, lambda p: P.is_copied_dir(p["kind"], p["copy_path"])).alias("has_copied_dir"),
            F.exists(arr, lambda p: P.is_diffable(p["path"], p["kind"], p["type"], mode)).alias("has_diffable"),
            arr.alias("changed_paths"),
        )
        return cls.from_described(described)

    @classmethod
    def from_described(cls, nested: DataFrame) -> "CommitLog":
        """From heads that still hold their paths."""
        return cls(nested.drop("changed_paths"), flatten_paths(nested), nested)

    @classmethod
    def from_flat(cls, entries: DataFrame, paths: DataFrame, unique_paths=True, mode="suffix") -> "CommitLog":
        """From an entry table and a path table.

        Paths are only ever folded into fixed-size aggregates, combined before
        the shuffle, so a commit that touches a third of all paths costs no
        task more than another.  Paths that are not unique are de-duplicated
        for the counts and flags only: the first path is the same either way,
        and a query that uses nothing else leaves that step out of its plan.
        """
        unique = paths if unique_paths else dedupe_paths(paths)
        first = F.min(F.struct("ordinal", "path"))["path"].alias("first_path")
        facts = [
            F.count(F.lit(1)).cast("int").alias("n_paths"),
            F.bool_or(P.is_copied_dir(F.col("kind"), F.col("copy_path"))).alias("copied"),
            F.bool_or(P.is_diffable(F.col("path"), F.col("kind"), F.col("type"), mode)).alias("diffable"),
        ]
        if unique_paths:
            joined = entries.join(unique.groupBy("revision").agg(first, *facts), "revision", "left")
        else:
            joined = entries.join(paths.groupBy("revision").agg(first), "revision", "left").join(
                unique.groupBy("revision").agg(*facts), "revision", "left"
            )
        heads = joined.select(
            "revision",
            "date",
            "author",
            "message",
            "first_path",
            F.coalesce("n_paths", F.lit(0)).alias("changed_files_count"),
            F.coalesce("copied", F.lit(False)).alias("has_copied_dir"),
            F.coalesce("diffable", F.lit(False)).alias("has_diffable"),
        )
        paths = unique.select("revision", "ordinal", "path", "type", "kind", "copy_path")
        return cls(heads, paths, entries=entries, mode=mode)

    def with_paths(self, paths: DataFrame) -> "CommitLog":
        """The log over a written copy of its paths, which are unique, so that they are not de-duplicated again."""
        if self.entries is None:
            return CommitLog(self.heads, paths)
        return CommitLog.from_flat(self.entries, paths, mode=self.mode)

    def between(self, start: int = 1, end: int | None = None) -> "CommitLog":
        if self.nested is not None:
            return CommitLog.from_described(revision_range(self.nested, start, end))
        heads, paths = revision_range(self.heads, start, end), revision_range(self.paths, start, end)
        entries = None if self.entries is None else revision_range(self.entries, start, end)
        return CommitLog(heads, paths, entries=entries, mode=self.mode)

    @cached_property
    def dated(self) -> DataFrame:
        """Heads that have a revision and a date; the others are in ``rejects``."""
        return self.heads.filter(~is_rejected())

    @cached_property
    def rejects(self) -> DataFrame:
        return self.heads.filter(is_rejected())

    def accepted(self) -> "CommitLog":
        """The log without rejected entries and their paths."""
        if self.nested is not None:
            return CommitLog.from_described(self.nested.filter(~is_rejected()))
        return CommitLog(self.dated, self.paths.join(self.dated, "revision", "left_semi"))


def is_rejected():
    return F.col("date").isNull() | F.col("revision").isNull()
