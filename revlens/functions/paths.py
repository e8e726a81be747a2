"""Column helpers for changed paths: branch labels, versions and diff policy."""

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revlens import rules


def third_segment(path: Column) -> Column:
    """Third path segment; null when the path ends before it."""
    return F.get(F.split(F.rtrim(path, F.lit("/")), "/"), F.lit(3))


def _inner_dot(version: Column) -> Column:
    """Whether a dot separates two tokens; dots at the end separate nothing."""
    return F.rtrim(version, F.lit(".")).contains(".")


def product_version(version: Column) -> Column:
    """First two dot-separated tokens; a shorter version is returned unchanged."""
    return F.when(_inner_dot(version), F.substring_index(version, ".", 2)).otherwise(version)


def is_short_version(version: Column) -> Column:
    return ~_inner_dot(version)


def _first_part(text: Column, separator: str) -> Column:
    # Nothing but separators has no first part at all.
    only_separators = (text != "") & (F.rtrim(text, F.lit(separator)) == "")
    return F.when(~only_separators, F.split_part(text, F.lit(separator), F.lit(1)))


def underscore_version(path: Column, prefix: str) -> Column:
    """Text between the prefix and the next slash."""
    return _first_part(F.substr(path, F.lit(len(prefix) + 1)), "/")


def underscore_product_version(version: Column) -> Column:
    return _first_part(version, "_")


def _by_rule(first_path: Column, branch_rules, value_of, otherwise: Column) -> Column:
    """The value of the first rule a path matches.  Prefixes are compared
    literally: some hold an underscore."""
    chain = F.when(first_path.isNull(), otherwise)
    for rule in branch_rules:
        chain = chain.when(first_path.startswith(rule.prefix), value_of(rule))
    return chain.otherwise(otherwise)


def branch_labels(first_path: Column, branch_rules=rules.BRANCH_RULES) -> dict[str, Column]:
    """Product, type, branch and full version of a commit, by its first path."""

    def full(rule):
        if rule.versioning == "dots":
            return third_segment(first_path)
        if rule.versioning == "underscores":
            return underscore_version(first_path, rule.prefix)
        return F.lit(rules.OTHER)

    values = {
        "product": lambda rule: F.lit(rule.product),
        "type": lambda rule: F.lit(rule.type),
        "branch": lambda rule: F.lit(rule.branch),
        "full_version": full,
    }
    return {
        name: _by_rule(first_path, branch_rules, value_of, F.lit(rules.OTHER)) for name, value_of in values.items()
    }


def short_version(first_path: Column, full_version: Column, branch_rules=rules.BRANCH_RULES) -> Column:
    """Product version of a commit, from the full version by the same rule."""
    shorten = {
        "dots": product_version(full_version),
        "underscores": underscore_product_version(full_version),
        "none": F.lit(rules.OTHER),
    }
    return _by_rule(first_path, branch_rules, lambda rule: shorten[rule.versioning], F.lit(rules.OTHER))


def with_branch_labels(heads: DataFrame, branch_rules=rules.BRANCH_RULES) -> DataFrame:
    """Heads with all five labels; the full version is worked out once."""
    first_path = F.col("first_path")
    labelled = heads.withColumns(branch_labels(first_path, branch_rules))
    return labelled.withColumn("product_version", short_version(first_path, F.col("full_version"), branch_rules))


def uses_dots(first_path: Column, branch_rules=rules.BRANCH_RULES) -> Column:
    """Whether the rule that applies takes a dot-separated version."""
    return _by_rule(first_path, branch_rules, lambda rule: F.lit(rule.versioning == "dots"), F.lit(False))


def is_copied_dir(kind: Column, copy_path: Column) -> Column:
    return F.coalesce((kind == "dir") & (F.coalesce(copy_path, F.lit("")) != ""), F.lit(False))


def is_changed_file(kind: Column, type_: Column) -> Column:
    return F.coalesce((kind == "file") & (type_ != "D"), F.lit(False))


def matches_skip_prefix(path: Column, prefixes=rules.SKIP_PREFIXES, mode="suffix") -> Column:
    """Paths under areas that need no diff, in any letter case.

    ``suffix`` tests how the path ends, the behaviour results depend on;
    ``prefix`` tests how it starts, which the name suggests.
    """
    lowered = F.lower(path)
    test = {"suffix": lowered.endswith, "prefix": lowered.startswith}[mode]
    return reduce(or_, [test(p.lower()) for p in prefixes])


def matches_skip_suffix(path: Column, suffixes=rules.SKIP_SUFFIXES) -> Column:
    lowered = F.lower(path)
    return reduce(or_, [lowered.endswith(s.lower()) for s in suffixes])


def is_diffable(path: Column, kind: Column, type_: Column, mode="suffix") -> Column:
    """A changed file outside the skipped areas and file types."""
    return (
        is_changed_file(kind, type_)
        & ~matches_skip_prefix(path, mode=mode)
        & ~matches_skip_suffix(path)
    )
