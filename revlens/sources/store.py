"""Stored tables: typed appends, exports and SQL registration."""

import re
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from revlens import schema

BUCKET_SPAN = 100_000
BUCKET = "rev_bucket"
# Columns without statistics.
LONG_TEXTS = ("message", "file")


def bucket(span: int):
    return F.expr(f"revision div {span}")


def typed(df: DataFrame, table: str) -> DataFrame:
    """Columns of a stored table in order, each of its declared type.

    A missing column fails, and so does one of another kind: whole numbers may be of
    any width and timestamps with or without a zone, other types must be the declared ones.
    """
    alike = (T.ByteType, T.ShortType, T.IntegerType, T.LongType), (T.TimestampType, T.TimestampNTZType)
    for declared in schema.TABLES[table].fields:
        given = df.schema[declared.name].dataType
        same = given == declared.dataType or isinstance(given, T.NullType)
        if not (same or any(isinstance(given, kind) and isinstance(declared.dataType, kind) for kind in alike)):
            raise TypeError(f"{table}.{declared.name} is {given.simpleString()}, not {declared.dataType.simpleString()}")
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.TABLES[table].fields])


def by_range(df: DataFrame, span: int = BUCKET_SPAN) -> DataFrame:
    """Lay rows out by ranges of revisions, ready to be written one folder each.

    Rebalancing brings a range together in one task, merges small ranges and
    splits one that holds far more rows than others.
    """
    return df.withColumn(BUCKET, bucket(span)).hint("rebalance", F.col(BUCKET))


def write_table(
    df: DataFrame, path: str, table: str, mode="append", span=BUCKET_SPAN, buckets_only=False, laid_out=False
) -> None:
    """Write typed rows, one folder per range of revisions, sorted in each file.

    ``laid_out`` says that ``df`` reads rows already laid out by range, so they
    are written without a shuffle.  ``buckets_only`` limits an overwrite to the
    ranges that ``df`` has rows for.
    """
    rows = typed(df, table)
    rows = rows.withColumn(BUCKET, bucket(span)) if laid_out else by_range(rows, span)
    (
        rows.sortWithinPartitions(BUCKET, "revision")
        .write.mode(mode)
        .option("partitionOverwriteMode", "dynamic" if buckets_only else "static")
        .partitionBy(BUCKET)
        .parquet(path)
    )


def write_tsv(df: DataFrame, path: str, mode="errorifexists") -> None:
    """Tab-separated values as they are: no header, no quoting, null as nothing."""
    cells = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in df.columns]
    df.select(F.concat_ws("\t", *cells)).write.mode(mode).text(path)


@dataclass(frozen=True)
class CommitStore:
    """The five tables below one folder.

    ``span`` is the number of revisions per folder of a table.  A store keeps the
    span it was made with, stored beside its tables, and refuses another; larger
    logs take a larger one, so that there are some thousand folders at most.
    """

    spark: SparkSession
    root: str
    span: int = BUCKET_SPAN
    _checked: list = field(default_factory=list, compare=False, repr=False)

    def check_span(self, record=False) -> None:
        """Compare the span with the stored one; ``record`` stores it if there is none."""
        if self._checked:
            return
        try:
            stored = self.spark.read.schema("span long").parquet(self.path("settings")).first()
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            stored = None
        if stored is not None and stored[0] != self.span:
            raise ValueError(f"the store at {self.root} has a span of {stored[0]}, not {self.span}")
        if stored is None and record:
            self.spark.range(1).selectExpr(f"{self.span}L AS span").write.mode("overwrite").parquet(self.path("settings"))
        if stored is not None or record:
            self._checked.append(self.span)

    def path(self, table: str) -> str:
        return f"{self.root.rstrip('/')}/{table}"

    def buckets(self, table: str) -> list[int]:
        """Numbers of the folders of a table, lowest first, from their names alone."""
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(self.path(table))
        system = folder.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not system.exists(folder):
            return []
        names = [found.getPath().getName() for found in system.listStatus(folder) if found.isDirectory()]
        return sorted(int(name.partition("=")[2]) for name in names if re.fullmatch(rf"{BUCKET}=-?\d+", name))

    def read_bucket(self, table: str, number: int) -> DataFrame:
        """The rows of one folder."""
        return self.read_buckets(table, keep_bucket=True).filter(F.col(BUCKET) == number).drop(BUCKET)

    def max_revision(self, table="commits") -> int | None:
        """The highest stored revision: that of the highest folder that holds one.  No other folder is read."""
        for number in reversed(self.buckets(table)):
            highest = self.read_bucket(table, number).agg(F.max("revision")).first()[0]
            if highest is not None:
                return highest
        return None

    def read_buckets(self, table: str, start: int | None = None, end: int | None = None, keep_bucket=False) -> DataFrame:
        """All rows of the folders that hold a revision range.  Missing means empty.

        ``keep_bucket`` adds the number of the folder, by which reads are pruned.
        """
        self.check_span()
        declared = schema.TABLES[table]
        with_bucket = T.StructType([*declared.fields, T.StructField(BUCKET, T.LongType())])
        try:
            df = self.spark.read.schema(with_bucket).parquet(self.path(table))
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], with_bucket if keep_bucket else declared)
        if start is not None:
            df = df.filter(F.col(BUCKET) >= start // self.span)
        if end is not None:
            df = df.filter(F.col(BUCKET) <= end // self.span)
        return df if keep_bucket else df.select(*declared.fieldNames())

    def read(self, table: str, start: int | None = None, end: int | None = None) -> DataFrame:
        """A stored table, or the rows of a revision range."""
        df = self.read_buckets(table, start, end)
        if start is not None:
            df = df.filter(F.col("revision") >= start)
        return df if end is None else df.filter(F.col("revision") <= end)

    def append(self, df: DataFrame, table: str, laid_out=False) -> None:
        self.check_span(record=True)
        write_table(df, self.path(table), table, span=self.span, laid_out=laid_out)

    def write_rejects(self, df: DataFrame, replace=False) -> None:
        """Add the entries that are not stored yet, or replace all.  Nulls equal nulls."""
        path = self.path("rejects")
        keys = [c for c in ("revision", "date", "author", "message") if c in df.columns]
        rows = df.dropDuplicates(keys)
        if replace:
            rows.write.mode("overwrite").parquet(path)
            return
        try:
            stored = self.spark.read.schema(df.schema).parquet(path)
            known = stored.select(*[F.col(c).alias(f"stored_{c}") for c in keys])
            rows = rows.join(known.hint("merge"), [F.col(c).eqNullSafe(F.col(f"stored_{c}")) for c in keys], "left_anti")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
        if not rows.isEmpty():
            rows.write.mode("append").parquet(path)

    def replace(self, df: DataFrame, table: str, laid_out=False) -> None:
        self.check_span(record=True)
        write_table(df, self.path(table), table, mode="overwrite", span=self.span, laid_out=laid_out)

    def replace_buckets(self, df: DataFrame, table: str) -> None:
        write_table(df, self.path(table), table, mode="overwrite", span=self.span, buckets_only=True)

    def tables(self) -> dict[str, DataFrame]:
        return {name: self.read(name) for name in schema.TABLES}


def register_tables(tables: dict[str, DataFrame], prefix="", joined_names=False) -> None:
    """Make tables queryable by SQL; registering one again is not an error.

    ``joined_names`` names columns without underscores (``fullversion``,
    ``changedfilescount``), so that scripts written for such names still run.
    """
    for name, df in tables.items():
        if joined_names:
            df = df.toDF(*[column.replace("_", "") for column in df.columns])
        df.createOrReplaceTempView(prefix + name)


def create_tables(
    spark: SparkSession, tables: dict[str, DataFrame], buckets: int, prefix="", folder: str | None = None
) -> None:
    """Catalog tables with statistics; existing ones are kept.

    The tables that reports join on revision again and again are bucketed and
    sorted by it, so those joins need no shuffle.  They hold one row per commit
    or, for issues, as many as one message can name.  Changed files are not
    joined by reports and one commit can have very many, so they stay unbucketed.
    ``folder`` places the tables there instead of in the warehouse.

    Statistics let sessions with ``spark.sql.cbo.enabled`` and
    ``spark.sql.cbo.joinReorder.enabled`` join in the order that the filters of a
    script suggest rather than in the order it names its tables.
    """
    for name, df in tables.items():
        if spark.catalog.tableExists(prefix + name):
            continue
        writer = typed(df, name) if name == "files" else typed(df, name).repartition(buckets, "revision")
        writer = writer.write.format("parquet")
        if folder is not None:
            writer = writer.option("path", f"{folder.rstrip('/')}/{prefix + name}")
        if name != "files":
            writer = writer.bucketBy(buckets, "revision").sortBy("revision")
        writer.saveAsTable(prefix + name)
        compute_statistics(spark, prefix + name)


def compute_statistics(spark: SparkSession, table: str, left_out=LONG_TEXTS) -> None:
    """Rows, bytes, and ranges and distinct values per column of a catalog table, read in one pass.

    Messages and paths are left out: no script compares them for equality and
    they are most of the bytes.  Call it again after a table has grown.
    """
    names = [f"`{column}`" for column in spark.table(table).columns if column not in left_out]
    spark.sql(f"ANALYZE TABLE {table} COMPUTE STATISTICS FOR COLUMNS {', '.join(names)}")
