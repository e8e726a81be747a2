"""Calendar parts of a commit date, evaluated in the session time zone."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def week_of_year(when: Column, rule="us") -> Column:
    """Week number; ``us`` weeks start on Sunday and week 1 holds 1 January."""
    if rule == "iso":
        return F.weekofyear(when)
    if rule != "us":
        raise ValueError(f"unknown week rule: {rule}")
    day = F.to_date(when)
    return F.when(_in_next_years_first_week(day), F.lit(1)).otherwise(
        (F.floor((F.dayofyear(day) + F.dayofweek(F.trunc(day, "year")) - 2) / 7) + 1).cast("int")
    )


def week_year(when: Column, rule="us") -> Column:
    """The year the week belongs to, which differs from the calendar year at its ends."""
    if rule == "iso":
        return F.extract(F.lit("YEAROFWEEK"), when).cast("int")
    day = F.to_date(when)
    return F.year(day) + F.when(_in_next_years_first_week(day), F.lit(1)).otherwise(F.lit(0))


def _in_next_years_first_week(day: Column) -> Column:
    return (F.month(day) == 12) & (F.date_add(day, F.lit(7) - F.dayofweek(day)) > F.last_day(day))


def hour12(when: Column) -> Column:
    """Hour on the 12-hour clock, 0 to 11."""
    return F.hour(when) % 12
