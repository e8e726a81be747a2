"""Column helpers for commit messages and the issue references in them."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from revlens import rules


def utf16_length(text: Column) -> Column:
    """Length in UTF-16 units, the unit in which text limits are stated."""
    return (F.octet_length(F.encode(text, "UTF-16BE")) / 2).cast("int")


def count_issue_marks(message: Column) -> Column:
    return F.length(message) - F.length(F.replace(message, F.lit("#"), F.lit("")))


def longer_than(text: Column, limit: int) -> Column:
    # A text never has more UTF-16 units than UTF-8 bytes, and the byte count is
    # at hand, so only really large texts are re-encoded.
    return (F.octet_length(text) > limit) & (utf16_length(text) > limit)


def too_long(message: Column, max_length=rules.MAX_MESSAGE_LENGTH) -> Column:
    return longer_than(message, max_length - 1)


def too_many_marks(message: Column, max_marks=rules.MAX_MESSAGE_MARKS) -> Column:
    # A message shorter than the limit needs no counting.
    return (F.octet_length(message) >= max_marks) & (count_issue_marks(message) >= max_marks)


def clean_message(
    message: Column,
    max_length=rules.MAX_MESSAGE_LENGTH,
    max_marks=rules.MAX_MESSAGE_MARKS,
) -> Column:
    size = utf16_length(message).cast("string")
    return (
        F.when(message.isNull(), F.lit(""))
        .when(too_long(message, max_length), F.concat(F.lit("this log message was too long: "), size))
        .when(
            too_many_marks(message, max_marks),
            F.concat(F.lit("this log message contained too many issues: "), size),
        )
        .otherwise(message)
    )


def issue_references(message: Column) -> Column:
    """Distinct references in a message.

    The pattern also takes the character before the mark; it is cut off unless
    the match starts with the mark itself, so ``##12345 - AB`` keeps both marks.
    """
    matches = F.regexp_extract_all(message, F.lit(rules.ISSUE_PATTERN), F.lit(0))
    strip = lambda m: F.when(m.startswith("#"), m).otherwise(F.substr(m, F.lit(2)))
    found = F.array_distinct(F.transform(matches, strip))
    # Most messages hold no mark at all and are spared the pattern.
    return F.when(message.contains("#"), found).otherwise(F.array().cast("array<string>"))


def is_bug(reference: Column) -> Column:
    size = F.length(reference)
    number = F.substring(reference, 2, 5).try_cast("bigint")
    return (size > rules.SHORT_BUG_LENGTH) | (
        (size == rules.SHORT_BUG_LENGTH) & F.coalesce(number > rules.LAST_SHORT_FEATURE, F.lit(False))
    )


def issue_type(reference: Column) -> Column:
    return F.when(is_bug(reference), F.lit("B")).otherwise(F.lit("F"))
