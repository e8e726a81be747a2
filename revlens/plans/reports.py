"""Activity reports.

Reports read *facts*: one row per commit with its version, calendar and commit
columns, and one row per issue reference for the issue reports.  Over a log,
facts are a projection of the log itself, so no report joins anything.  Over
stored tables they are joins on the revision, which bucketed tables need not
shuffle.  Every report combines before its shuffle.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revlens import rules
from revlens.functions import calendar as C
from revlens.functions import messages as M
from revlens.functions import paths as P
from revlens.sources.commit_log import CommitLog


def _fact_columns(week_rule) -> list:
    when = F.col("date")
    return [
        F.col("revision"),
        F.to_date(when).alias("date"),
        F.year(when).alias("year"),
        F.month(when).alias("month"),
        C.week_of_year(when, week_rule).alias("week"),
        F.col("branch"),
        F.col("product_version"),
        F.col("full_version"),
        F.col("author"),
        F.col("changed_files_count"),
        M.clean_message(F.col("message")).alias("message"),
    ]


def commit_facts(log: CommitLog, week_rule="us", branch_rules=rules.BRANCH_RULES) -> DataFrame:
    """Facts straight from the log, without building tables."""
    return P.with_branch_labels(log.dated, branch_rules).select(*_fact_columns(week_rule))


def issue_facts(log: CommitLog, week_rule="us", branch_rules=rules.BRANCH_RULES) -> DataFrame:
    """Commit facts once per issue reference, with the reference and its type."""
    # Exploding the expression itself, not a column of it, keeps the optimizer
    # from adding filters that search each message again.
    reference = F.explode(M.issue_references(F.col("message"))).alias("reference")
    return (
        P.with_branch_labels(log.dated, branch_rules)
        .select(*_fact_columns(week_rule), reference)
        .withColumn("type", M.issue_type(F.col("reference")))
    )


def stored_commit_facts(tables: dict[str, DataFrame]) -> DataFrame:
    """The same facts from stored tables."""
    labels = tables["version"].select("revision", "branch", "product_version", "full_version")
    calendar = tables["date_time"].select("revision", "year", "month", "week")
    return tables["commits"].join(labels, "revision").join(calendar, "revision")


def stored_issue_facts(tables: dict[str, DataFrame]) -> DataFrame:
    references = tables["issues"].select("revision", "reference", "type")
    return stored_commit_facts(tables).join(references, "revision")


def in_production(facts: DataFrame) -> DataFrame:
    return facts.filter(F.col("branch").isin(*rules.PRODUCTION_BRANCHES))


def prod_commits_with_issues(issue_rows: DataFrame, year: int = 2015) -> DataFrame:
    """Production commits of a year with the issues they name."""
    return (
        in_production(issue_rows)
        .filter(F.col("year") == year)
        .select("revision", "type", "reference", "full_version", "year", "month", "author", "message")
        .orderBy("full_version", "revision", "type", "reference")
    )


def revision_span(commits: DataFrame) -> DataFrame:
    return commits.agg(
        F.count(F.lit(1)).alias("cnt"), F.min("revision").alias("minrev"), F.max("revision").alias("maxrev")
    )


def commits_per_branch_month(facts: DataFrame) -> DataFrame:
    return (
        facts.groupBy("branch", "year", "month")
        .agg(F.count(F.lit(1)).alias("commits_count"))
        .select("branch", "commits_count", "year", "month")
        .orderBy(F.desc("year"), F.desc("month"), "branch")
    )


def commits_per_version_month(facts: DataFrame) -> DataFrame:
    return (
        in_production(facts)
        .groupBy("full_version", "year", "month")
        .agg(F.count(F.lit(1)).alias("commits_count"))
        .select("full_version", "commits_count", "year", "month")
        .orderBy(F.desc("year"), F.desc("month"), F.desc("full_version"))
    )


def files_per_commit_month(facts: DataFrame) -> DataFrame:
    """Commits, changed files and their ratio, truncated (``fpc``) and exact."""
    return (
        facts.groupBy("branch", "year", "month")
        .agg(F.count(F.lit(1)).alias("cmts"), F.sum("changed_files_count").alias("cf"))
        .select(
            "branch",
            "cmts",
            "cf",
            F.expr("cf div cmts").alias("fpc"),
            (F.col("cf") / F.col("cmts")).alias("fpc_exact"),
            "year",
            "month",
        )
        .orderBy(F.desc("year"), F.desc("month"), "branch")
    )


def issues_per_branch_month(issue_rows: DataFrame) -> DataFrame:
    return (
        in_production(issue_rows)
        .groupBy("branch", "type", "year", "month")
        .agg(F.count_distinct("reference").alias("issues"))
        .select("issues", "type", "branch", "year", "month")
        .orderBy(F.desc("year"), F.desc("month"), "branch", "type")
    )


def issues_authors_per_version_month(issue_rows: DataFrame) -> DataFrame:
    return (
        in_production(issue_rows)
        .groupBy("full_version", "product_version", "type", "year", "month")
        .agg(F.count_distinct("reference").alias("issues"), F.count_distinct("author").alias("authors"))
        .select("issues", "type", "full_version", "product_version", "year", "month", "authors")
        .orderBy(F.desc("year"), F.desc("month"), "full_version", "type", "product_version")
    )


def branches_per_week(facts: DataFrame) -> DataFrame:
    return (
        in_production(facts)
        .groupBy("year", "week")
        .agg(F.count_distinct("full_version").alias("branches"))
        .select("branches", "year", "week")
        .orderBy(F.desc("year"), F.desc("week"))
    )


def branches_authors_per_week(facts: DataFrame) -> DataFrame:
    return (
        in_production(facts)
        .groupBy("year", "week")
        .agg(F.count_distinct("full_version").alias("branches"), F.count_distinct("author").alias("authors"))
        .select("branches", "authors", "year", "week", F.concat_ws("_", "year", "week").alias("yw"))
        .orderBy(F.desc("year"), F.desc("week"))
    )


def issues_per_author_week(issue_rows: DataFrame, author: str, top: int = 30) -> DataFrame:
    """The first ``top`` weeks of one author, with the issues named in each."""
    return (
        issue_rows.filter(F.col("author") == author)
        .groupBy("author", "year", "week")
        .agg(F.count_distinct("reference").alias("cnt"))
        .orderBy("author", "year", "week")
        .limit(top)
    )


def team_activity(labelled: DataFrame) -> DataFrame:
    """Commits per team and role by month, from labelled commits."""
    return (
        labelled.groupBy("team", "role", F.year("date").alias("year"), F.month("date").alias("month"))
        .agg(F.count(F.lit(1)).alias("commits_count"))
        .orderBy("year", "month", "team", "role")
    )


def load_report(commits: DataFrame) -> DataFrame:
    first, last = F.min("revision"), F.max("revision")
    return commits.agg(
        F.count(F.lit(1)).alias("lines_cnt"),
        first.alias("min_rev"),
        last.alias("max_rev"),
        (last - first).alias("max_min"),
    )


def loaded(report: DataFrame, found: dict | None, warned: str) -> DataFrame:
    """A report on a store with what a load observed in its log; nulls if there was nothing to load.

    Counts of warnings, whose names begin with ``warned``, become a map; kinds that did not occur are left out.
    """
    columns = {
        name: F.lit((found or {}).get(name)).cast("bigint")
        for name in (
            "n_loaded", "n_rejected", "first_revision", "files_of_first", "last_revision", "files_of_last",
            "diffs_needed", "diffs_skipped",
        )
    }
    counts = {k.removeprefix(warned): n for k, n in (found or {}).items() if k.startswith(warned) and n}
    pairs = [F.lit(x) for kind, n in counts.items() for x in (kind, n)]
    return report.withColumns(columns).withColumn("warnings", F.create_map(*pairs).cast("map<string,bigint>"))


def boundary_rows(commits: DataFrame, start: int, end: int) -> DataFrame:
    """The two commits at the ends of a range, with their number of changed files."""
    return commits.filter(F.col("revision").isin(start, end)).select("revision", "changed_files_count")
