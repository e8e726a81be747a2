"""Log to the five tables.  Each builder is a projection: none of them shuffles."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revlens import rules
from revlens.functions import calendar as C
from revlens.functions import messages as M
from revlens.functions import paths as P
from revlens.sources.commit_log import CommitLog

NO_DIFF_SIZE = -1


def commits(heads: DataFrame) -> DataFrame:
    """Labels and diff sizes are empty unless the heads already carry them."""
    blank = {"team": F.lit(""), "role": F.lit(""), "diff_size": F.lit(NO_DIFF_SIZE).cast("bigint")}
    team, role, diff_size = (
        F.col(name) if name in heads.columns else value.alias(name) for name, value in blank.items()
    )
    return heads.select(
        "revision",
        F.to_date("date").alias("date"),
        "author",
        team,
        role,
        "changed_files_count",
        diff_size,
        M.clean_message(F.col("message")).alias("message"),
    )


def files(paths: DataFrame) -> DataFrame:
    return paths.select("revision", "type", "kind", F.col("path").alias("file"))


def date_time(heads: DataFrame, week_rule="us", extras=False) -> DataFrame:
    """Calendar parts; ``extras`` adds the 24-hour clock and the week's own year."""
    when = F.col("date")
    columns = [
        F.col("revision"),
        F.to_date(when).alias("date"),
        F.date_format(when, "HH:mm:ss").alias("time"),
        when.alias("datetime"),
        F.year(when).alias("year"),
        F.month(when).alias("month"),
        F.day(when).alias("day"),
        C.week_of_year(when, week_rule).alias("week"),
        F.dayofweek(when).alias("day_of_week"),
        C.hour12(when).alias("hour"),
        F.minute(when).alias("minutes"),
        F.second(when).alias("sec"),
    ]
    if extras:
        columns += [F.hour(when).alias("hour24"), C.week_year(when, week_rule).alias("week_year")]
    return heads.select(*columns)


def version(heads: DataFrame, branch_rules=rules.BRANCH_RULES) -> DataFrame:
    labels = ("product", "type", "branch", "product_version", "full_version")
    return P.with_branch_labels(heads, branch_rules).select("revision", *labels)


def issues(heads: DataFrame) -> DataFrame:
    """Issue references of the raw message, not of the cleaned one."""
    found = heads.select("revision", F.explode(M.issue_references(F.col("message"))).alias("reference"))
    return found.select(
        "revision",
        M.issue_type(F.col("reference")).alias("type"),
        "reference",
        F.lit("").alias("notes_client_url"),
        F.lit("").alias("notes_web_url"),
    )


def build(log: CommitLog, week_rule="us", branch_rules=rules.BRANCH_RULES) -> dict[str, DataFrame]:
    heads = log.dated
    return {
        "commits": commits(heads),
        "files": files(log.paths),
        "date_time": date_time(heads, week_rule),
        "version": version(heads, branch_rules),
        "issues": issues(heads),
    }


def warning_findings(branch_rules=rules.BRANCH_RULES, full_version=None, doubled=None) -> dict[str, tuple]:
    """Condition and detail of each kind of odd input, over the columns of heads.

    ``full_version`` and ``doubled`` are the columns that hold these where they were worked out before.
    """
    message, path = F.col("message"), F.col("first_path")
    full = P.branch_labels(path, branch_rules)["full_version"] if full_version is None else full_version
    doubled = doubled_marks() if doubled is None else doubled
    long = M.too_long(message)
    short = P.uses_dots(path, branch_rules) & full.isNotNull() & P.is_short_version(full)
    return {
        "message is too long": (long, M.utf16_length(message)),
        "message contains too many issues": (~long & M.too_many_marks(message), M.count_issue_marks(message)),
        "full version is too short": (short, full),
        "path holds no version": (path.isNotNull() & full.isNull(), path),
        "reference has a doubled mark": (F.size(doubled) > 0, F.array_join(doubled, ", ")),
    }


def doubled_marks():
    doubled = F.filter(
        M.issue_references(F.col("message")),
        lambda r: (F.length(r) == rules.SHORT_BUG_LENGTH) & F.substring(r, 2, 5).try_cast("bigint").isNull(),
    )
    # Digits follow a single mark, so most messages are spared the pattern.
    return F.when(F.col("message").contains("##"), doubled).otherwise(F.array().cast("array<string>"))


def warnings(heads: DataFrame, branch_rules=rules.BRANCH_RULES) -> DataFrame:
    """Odd input, one row per finding: ``revision, warning, detail``.

    All findings of a row are listed in one pass over the log.
    """
    # Worked out once; the findings use them several times.
    judged = heads.select(
        "revision",
        "message",
        "first_path",
        P.branch_labels(F.col("first_path"), branch_rules)["full_version"].alias("full_version"),
        doubled_marks().alias("doubled"),
    )
    findings = warning_findings(branch_rules, F.col("full_version"), F.col("doubled"))
    found = F.array(
        *[
            F.when(condition, F.struct(F.lit(name).alias("warning"), detail.cast("string").alias("detail")))
            for name, (condition, detail) in findings.items()
        ]
    )
    return judged.select("revision", F.explode(F.array_compact(found)).alias("w")).select("revision", "w.*")
