"""Column helpers for people, groups and multi-value document fields."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def name_key(full_name: Column) -> Column:
    """Lower-cased common name: the second token of ``CN=Ann Example/OU/ORG``,
    or the whole text when it has no ``=`` or ``/`` parts."""
    tokens = F.split(F.rtrim(full_name, F.lit("=/")), "[=/]")
    return F.lower(F.when(F.size(tokens) == 1, full_name).otherwise(F.get(tokens, F.lit(1))))


def member_to_user(member: Column) -> Column:
    """User id of a group member: initial and surname of a two-word name."""
    key = name_key(member)
    words = F.split(F.rtrim(key), " ")
    first, last = F.get(words, F.lit(0)), F.get(words, F.lit(1))
    return F.when(F.size(words) == 2, F.concat(F.substring(first, 1, 1), last)).otherwise(key)


def camel_case(text: Column) -> Column:
    proper = lambda part: F.concat(F.upper(F.substring(part, 1, 1)), F.lower(F.substr(part, F.lit(2))))
    return F.array_join(F.transform(F.split(text, " "), proper), "")


def item_or_default(values: Column, default: str) -> Column:
    """First value of a multi-value field, or the default when there is none."""
    return F.coalesce(F.get(values, F.lit(0)), F.lit(default))
