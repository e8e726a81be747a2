"""Which commits need a diff, which have one, and how large it is."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from revlens.functions import paths as P
from revlens.operators.tables import NO_DIFF_SIZE
from revlens.session import materialize
from revlens.sources.commit_log import revision_range


def needs_diff_column() -> Column:
    """No copied directory, and at least one changed file that is not skipped."""
    return ~F.col("has_copied_dir") & F.col("has_diffable")


def needs_diff(heads: DataFrame) -> DataFrame:
    return heads.select("revision", needs_diff_column().alias("needs_diff"))


def path_checks(paths: DataFrame, mode="suffix") -> DataFrame:
    """The four tests behind the policy, per changed path."""
    path, kind, type_ = F.col("path"), F.col("kind"), F.col("type")
    return paths.select(
        "revision",
        "path",
        P.is_copied_dir(kind, F.col("copy_path")).alias("is_copied_dir"),
        P.matches_skip_prefix(path, mode=mode).alias("skip_prefix"),
        P.matches_skip_suffix(path).alias("skip_suffix"),
        P.is_changed_file(kind, type_).alias("is_changed_file"),
    )


def worklist(heads: DataFrame, sizes: DataFrame) -> DataFrame:
    """Revisions that need a diff and have no file yet."""
    return heads.filter(needs_diff_column()).select("revision").join(sizes, "revision", "left_anti")


def obsolete(heads: DataFrame, sizes: DataFrame) -> DataFrame:
    """Diff files of commits that need none; setting them aside is up to the caller."""
    unneeded = heads.filter(~needs_diff_column()).select("revision")
    return sizes.join(unneeded, "revision", "left_semi")


def update_sizes(commits: DataFrame, sizes: DataFrame, start: int = 1, end: int | None = None) -> DataFrame:
    """Set the diff size of commits in range: the file's size, or -1 without a file.

    Of several files of a revision the largest counts.
    """
    known = revision_range(sizes, start, end).groupBy("revision").agg(F.max("length").alias("found_size"))
    in_range = F.col("revision") >= start
    if end is not None:
        in_range &= F.col("revision") <= end
    size = F.when(in_range, F.coalesce("found_size", F.lit(NO_DIFF_SIZE))).otherwise(F.col("diff_size"))
    return (
        commits.join(known.hint("merge"), "revision", "left")
        .withColumn("diff_size", size.cast("bigint"))
        .select(*commits.columns)
    )


def progress(heads: DataFrame) -> DataFrame:
    return heads.agg(
        F.count(F.lit(1)).alias("expected"),
        F.count_if(needs_diff_column()).alias("submitted"),
        F.count_if(~needs_diff_column()).alias("skipped"),
    )


def refresh(commits: DataFrame, heads: DataFrame, sizes: DataFrame, start: int = 1, end: int | None = None) -> DataFrame:
    """Diff sizes of a range re-derived; files of commits that need none do not count.

    Sizes are merged: small as their files are, they hold millions of rows that a broadcast would send to the driver.
    """
    unneeded = revision_range(heads, start, end).filter(~needs_diff_column()).select("revision")
    return update_sizes(commits, sizes.join(unneeded.hint("merge"), "revision", "left_anti"), start, end)


def with_sizes(heads: DataFrame, sizes: DataFrame, slot: Column) -> DataFrame:
    """Heads with the diff size of each commit, as a refresh of all of them gives, laid out by ``slot``.

    Sizes travel as rows of their own, without any other column, to the slot of their
    revision, where they stand before its head; a running maximum then hands each on.
    So the one exchange that lays heads out also joins them.  ``slot`` is an expression
    of the revision alone; rows without a revision are spread by the rest of the entry.
    """
    by = [F.col(name) for name in ("date", "author", "message") if name in heads.columns]
    rows = heads.withColumn("found_size", F.lit(None).cast("bigint")).withColumn("is_head", F.lit(True))
    files = sizes.filter("revision is not null").select(
        "revision", F.col("length").cast("bigint").alias("found_size"), F.lit(False).alias("is_head")
    )
    spread = F.when(F.col("revision").isNull(), F.xxhash64(*by)).otherwise(slot)
    met = rows.unionByName(files, allowMissingColumns=True).withColumn("slot", spread)
    before = Window.partitionBy("slot", "revision").orderBy("is_head").rowsBetween(Window.unboundedPreceding, 0)
    found = met.repartition("slot").withColumn("found_size", F.max("found_size").over(before)).filter("is_head")
    size = F.when(needs_diff_column() & F.col("revision").isNotNull(), F.col("found_size"))
    return found.withColumn("diff_size", F.coalesce(size, F.lit(NO_DIFF_SIZE).cast("bigint"))).drop(
        "found_size", "is_head", "slot"
    )


def watchlist(heads: DataFrame, paths: DataFrame, revisions: DataFrame, limit: int | None = None) -> DataFrame:
    """Whether listed revisions need a diff, next to each of their paths.

    ``limit`` keeps only the lowest listed revisions.
    """
    listed = revisions.select("revision")
    if limit is not None:
        listed = listed.distinct().orderBy("revision").limit(limit)
    judged = heads.join(listed, "revision", "left_semi").select(
        "revision", needs_diff_column().alias("needs_diff"), "changed_files_count"
    )
    # Written, so that the join broadcasts it or not by its true size.  Inner, so
    # that a commit with very many paths can be split between tasks; commits
    # without paths are added.
    judged = materialize(judged, "watchlist")
    shown = ["revision", "needs_diff", "type", "kind", "path"]
    bare = judged.filter("changed_files_count = 0")
    for name in ("type", "kind", "path"):
        bare = bare.withColumn(name, F.lit(None).cast("string"))
    return judged.join(paths, "revision").select(*shown).unionAll(bare.select(*shown))
