"""Full, incremental and diff-only loads of the stored tables."""

from functools import partial, reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from revlens import rules, schema
from revlens.operators import diffs, tables, teams
from revlens.plans import reports
from revlens.session import broadcast_if_small, discard, in_parallel, materialize, scratch_dir
from revlens.sources.commit_log import CommitLog, is_rejected
from revlens.sources.store import BUCKET, CommitStore, bucket, by_range

#: Names of the counts of warnings begin so.
WARNED = "warned: "
#: Tasks that share a range of revisions when diff sizes are laid out with the log.
RANGE_PARTS = 4

UPDATE_OR_REBUILD, UPDATE, FORCE_REBUILD = "updateOrRebuild", "update", "forceRebuild"


def max_revision(commits: DataFrame) -> DataFrame:
    """Highest loaded revision, null when nothing is loaded."""
    return commits.agg(F.max("revision").alias("max_revision"))


def plan_columns(action: Column, db: Column, repo: Column, start: Column, end: Column) -> dict[str, Column]:
    """Status and range of a load.

    ``db`` is the highest loaded revision (null: none), ``repo`` the newest
    available, ``end`` null for the newest.  A range that ends before it starts
    is no range.
    """
    last = F.coalesce(end, repo)
    merging = action == UPDATE_OR_REBUILD
    fresh = (action == FORCE_REBUILD) | (merging & (db.isNull() | (db < start)))
    resuming = (action == UPDATE) | (merging & (db < repo))
    first = F.when(fresh, start).when(resuming, F.coalesce(db, F.lit(0)) + 1)
    status = (
        F.when(first <= last, F.lit("load"))
        .when(first.isNotNull(), F.lit("empty"))
        .when(db == repo, F.lit("up to date"))
        .otherwise(F.lit("corrupted"))
    )
    return {
        "status": status,
        "lo": F.when(first <= last, first),
        "hi": F.when(first <= last, last),
    }


def plan_load(
    loaded: DataFrame | int | None,
    available: DataFrame | int,
    action: str,
    start: int = 1,
    end: int | None = None,
    spark: SparkSession | None = None,
) -> DataFrame:
    """One row ``action, db, repo, status, lo, hi`` for a store and a log.

    ``loaded`` are the stored commits, or their highest revision as ``CommitStore.max_revision``
    knows it from the folders; ``available`` is the log, or its newest revision where
    that is known.  With two numbers, ``spark`` says where to plan.
    """

    def highest(side, name):
        if isinstance(side, DataFrame):
            return side.agg(F.max("revision").alias(name))
        return F.lit(side).cast("bigint").alias(name)

    sides = {"db": highest(loaded, "db"), "repo": highest(available, "repo")}
    frames = [side.select("*", F.lit(1).alias("one")) for side in sides.values() if isinstance(side, DataFrame)]
    numbers = [side for side in sides.values() if not isinstance(side, DataFrame)]
    if frames:
        both = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
        scalars = both.groupBy().agg(*[F.max(name).alias(name) for name in sides if name in both.columns]).select("*", *numbers)
    else:
        scalars = spark.range(1).select(*numbers)
    plan = plan_columns(
        F.lit(action), F.col("db"), F.col("repo"), F.lit(start).cast("bigint"), F.lit(end).cast("bigint")
    )
    return scalars.select(
        F.lit(action).alias("action"), "db", "repo", *[column.alias(name) for name, column in plan.items()]
    )


def ingest(
    log: CommitLog,
    store: CommitStore,
    author_rules: DataFrame | None = None,
    sizes: DataFrame | None = None,
    week_rule="us",
    branch_rules=rules.BRANCH_RULES,
    mode="append",
) -> dict:
    """Load a log into the five tables, skipping rows a table already has; says what was in the log.

    The log is read once, labelled and laid out by revision range in the shared
    folder; the tables are projections of that copy, written side by side.  Commits
    and files keep its layout; the narrow tables are laid out again, so that they
    are not cut into as many files as the log.  The copy goes when all is stored.  Commits, which loads are planned from, come last:
    a load that was cut short has not stored them, is planned again, and adds
    what each table lacks by its own keys.  Entries without a revision or date go
    to a reject table, each once; a rebuild replaces that table too.

    What the log holds is counted while the copy is written: see ``metrics``.
    """
    spark = log.heads.sparkSession
    staged = scratch_dir(spark, "load")
    observed = Observation()
    copy = _stage(log, store.span, author_rules, sizes, staged, observed, metrics(branch_rules))
    found = observed.get
    _store(copy, store, week_rule, branch_rules, mode, found)
    discard(spark, staged)
    return found


def metrics(branch_rules=rules.BRANCH_RULES) -> list[Column]:
    """Counts over heads: entries and rejects, the two ends, the diff policy and each kind of warning."""
    good = ~is_rejected()
    needed = good & diffs.needs_diff_column()
    findings = tables.warning_findings(branch_rules).items()
    return [
        F.count_if(good).alias("n_loaded"),
        F.count_if(~good).alias("n_rejected"),
        F.min("revision").alias("lowest"),
        F.max("revision").alias("highest"),
        F.min_by("changed_files_count", F.when(good, F.col("revision"))).alias("files_of_first"),
        F.max_by("changed_files_count", F.when(good, F.col("revision"))).alias("files_of_last"),
        F.min(F.when(good, F.col("revision"))).alias("first_revision"),
        F.max(F.when(good, F.col("revision"))).alias("last_revision"),
        F.count_if(needed).alias("diffs_needed"),
        F.count_if(good & ~needed).alias("diffs_skipped"),
        *[F.count_if(good & F.coalesce(condition, F.lit(False))).alias(f"{WARNED}{name}") for name, (condition, _) in findings],
    ]


def _store(log: CommitLog, store: CommitStore, week_rule, branch_rules, mode, found: dict) -> None:
    """Write the tables of a staged log."""
    spark = log.heads.sparkSession
    lo, hi, n_rejected = found["lowest"], found["highest"], found["n_rejected"]
    if n_rejected or mode == "overwrite":
        store.write_rejects(log.rejects.drop(BUCKET), replace=mode == "overwrite")
    if n_rejected:
        log = log.accepted()
    if lo is None and mode == "append":
        return
    built = tables.build(log, week_rule, branch_rules)

    def write(name: str) -> None:
        keys = schema.UNIQUE_KEYS[name]
        rows, stored = built[name], store.read(name, lo, hi).select(*keys)
        laid_out = name == "commits" or name == "files" and (not n_rejected or log.nested is not None)
        if mode == "overwrite":
            store.replace(rows, name, laid_out)
        elif stored.isEmpty():
            store.append(rows, name, laid_out)
        else:
            # Merged: planned by the size of compressed files, the keys of millions of rows would be broadcast.
            store.append(rows.join(stored.hint("merge"), keys, "left_anti"), name)

    store.check_span(record=True)
    in_parallel(spark, *[partial(write, name) for name in built if name != "commits"])
    write("commits")


def _stage(
    log: CommitLog,
    span: int,
    author_rules: DataFrame | None,
    sizes: DataFrame | None,
    below: str,
    observed: Observation,
    counts: list[Column],
) -> CommitLog:
    """Write a log, with labels and diff sizes, laid out by range, into a folder, and count it on the way."""

    def label(heads: DataFrame) -> DataFrame:
        if author_rules is None:
            return heads
        return teams.assign_team_role(heads.withColumns({"team": F.lit(""), "role": F.lit("")}), author_rules)

    def lay_out(heads: DataFrame) -> DataFrame:
        if sizes is None:
            return by_range(label(heads), span)
        # a range is shared by a few tasks, so that one of wide entries does not fall to a single one
        slot = F.expr(f"revision div {max(1, span // RANGE_PARTS)}")
        return diffs.with_sizes(label(heads), sizes, slot).withColumn(BUCKET, bucket(span))

    # A file holds whole ranges; a folder for each would only cost the renames and listings of thousands.
    if log.nested is not None:
        return CommitLog.from_described(materialize(lay_out(log.nested).observe(observed, *counts), "log", below=below))
    paths = materialize(by_range(log.paths, span), "paths", below=below)
    heads = lay_out(log.with_paths(paths).heads).observe(observed, *counts)
    return CommitLog(materialize(heads, "heads", below=below), paths)


def load(
    log: CommitLog,
    store: CommitStore,
    action: str = UPDATE_OR_REBUILD,
    start: int = 1,
    end: int | None = None,
    newest: int | None = None,
    **options,
) -> DataFrame:
    """Plan a load, run it and report on the store and on what was loaded.

    ``newest`` is the log's newest revision; giving it saves a pass over the log.
    Team rules, if given, are applied to the commits stored before as well.  Diff
    sizes are set only from ``sizes``; without them new commits have none and
    those stored before keep theirs.

    The report has one row: the totals of the store, and of the log that was loaded its
    entries and rejects, its first and last commit with their number of changed files,
    how many of its commits need a diff, and its warnings by kind.
    """
    found = None
    if action == FORCE_REBUILD:
        found = ingest(log.between(start, end), store, mode="overwrite", **options)
    else:
        loaded = store.max_revision()
        plan = plan_load(loaded, log.heads if newest is None else newest, action, start, end, spark=store.spark).first()
        if options.get("author_rules") is not None and loaded is not None:
            relabel(store, options["author_rules"])
        if plan["status"] == "load":
            found = ingest(log.between(plan["lo"], plan["hi"]), store, **options)
    return reports.loaded(reports.load_report(store.read("commits")), found, WARNED)


def relabelled(store: CommitStore, author_rules: DataFrame) -> tuple[DataFrame, DataFrame]:
    """All stored commits under the rules, with their folder, and the folders in which a label changes.

    The stored labels go through the labelling beside the new ones, so commits are not joined
    with themselves, and of the commits that decide only author, date and labels are read.
    """
    stored = store.read_buckets("commits", keep_bucket=True)
    kept = stored.withColumn("before", F.struct("team", "role"))
    labelled = teams.assign_team_role(kept, author_rules)
    changed = labelled.filter(~F.struct("team", "role").eqNullSafe(F.col("before"))).select(BUCKET).distinct()
    return labelled.drop("before"), changed


def in_folders(rows: DataFrame, folders: DataFrame) -> DataFrame:
    """Rows of the given folders; the scan of ``rows`` learns which ones while the query runs and reads no others.

    ``folders`` is a written table, a row per folder of a store, of which there are some thousand
    at most.  The condition on it says nothing new, but Spark prunes only by a side that is filtered.
    """
    lowest = folders.agg(F.min(BUCKET)).first()[0]
    some = folders.filter(F.col(BUCKET) >= lowest)
    return rows.join(broadcast_if_small(some), BUCKET, "left_semi")


def relabel(store: CommitStore, author_rules: DataFrame) -> int:
    """Apply changed team rules to all stored commits; only ranges where a label changes are rewritten.

    Returns their number.
    """
    folder = scratch_dir(store.spark, "relabel")
    labelled, changed = relabelled(store, author_rules)
    touched = materialize(changed, "folders", below=folder)
    n = touched.count()
    if n:
        store.replace_buckets(in_folders(labelled, touched).drop(BUCKET), "commits")
    discard(store.spark, folder)
    return n


def refresh_diffs(
    log: CommitLog, store: CommitStore, sizes: DataFrame, start: int = 1, end: int | None = None
) -> DataFrame:
    """Re-derive the diff sizes of a range; only the folders it touches are rewritten.

    The end defaults to the highest loaded revision.
    """
    if end is None:
        end = max_revision(store.read("commits")).first()[0]
    if end is not None and start <= end:
        touched = store.read_buckets("commits", start, end)
        store.replace_buckets(diffs.refresh(touched, log.heads, sizes, start, end), "commits")
    return reports.load_report(store.read("commits"))
