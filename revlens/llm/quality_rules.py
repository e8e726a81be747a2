"""Quality rules: one table of thresholds compiled into one projection.

Words are runs of characters other than space, tab, line feed, vertical tab,
form feed and carriage return.  A null text counts as an empty one: no words,
so it fails.  All measures cover the whole text; every row is judged on its
own, so ties, repeated rows and other columns have no influence.
"""

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLANKS = " \t\n\x0b\f\r"

# Frequent function words of the languages served.
STOP_WORDS = (
    "the be to of and that have with in is it for a on was this "
    "der die das und ist von zu den mit ein eine nicht auf für des "
    "le la les de et un une que est du dans pour des en sur "
    "el los las y es por con del al se una no para"
).split()


@dataclass(frozen=True)
class Rule:
    """Keep a document if least <= measure <= most; the measure is a SQL expression."""

    name: str
    measure: str
    least: float | None = None
    most: float | None = None


#: Ratios are by words, or by lines with a word.  Names are those of ``measures``.
RULES = (
    Rule("words", "n_words", least=50),
    Rule("repeated_windows", "n_repeat_words / greatest(n_words, 1)", most=0.5),
    Rule("word_length", "word_chars / greatest(n_words, 1)", least=2.0, most=14.0),
    Rule("symbols", "n_symbols / greatest(n_words, 1)", most=0.25),
    Rule("stop_words", "n_stop_words / greatest(n_words, 1)", least=0.03),
    Rule("bullet_lines", "n_bullet_lines / greatest(n_lines, 1)", most=0.9),
    Rule("ellipsis_lines", "n_ellipsis_lines / greatest(n_lines, 1)", most=0.3),
    Rule("repeated_lines", "n_dup_lines / greatest(n_lines, 1)", most=0.5),
    Rule("exclamations", "n_exclaimed / greatest(n_words, 1)", most=0.3),
)
#: The rules that any set of rules contains.
BASE = ("words", "repeated_windows")


def _repeat_words(words: Column) -> Column:
    """Words that lie in a 3-word window found twice or more.

    Windows are compared by a 64-bit hash of their words.  Only texts that
    repeat one are sorted; the flagged starts then count three words each, less
    what the next one covers too.
    """
    windows = F.when(
        F.size(words) >= 3,
        F.transform(
            F.sequence(F.lit(0), F.size(words) - 3),
            lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)),
        ),
    ).otherwise(F.array().cast("array<bigint>"))

    def counted(hashes: Column) -> Column:
        placed = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def starts(ordered: Column) -> Column:
            kept = F.filter(
                F.transform(
                    ordered,
                    lambda x, k: F.when(
                        (x["h"] == F.get(ordered, k - 1)["h"]) | (x["h"] == F.get(ordered, k + 1)["h"]), x["i"]
                    ),
                ),
                lambda i: i.isNotNull(),
            )
            return F.array_sort(kept)

        def covered(at: Column) -> Column:
            return F.aggregate(
                at,
                F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(-3).alias("last")),
                lambda acc, i: F.struct(
                    (acc["n"] + F.least(F.lit(3), i - acc["last"])).alias("n"), i.alias("last")
                ),
                lambda acc: acc["n"],
            )

        return _let(_let(placed, starts), covered)

    return _let(
        windows,
        lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0).cast("bigint")).otherwise(counted(h)),
    )


def _let(value: Column, body) -> Column:
    """``body(value)`` with the value worked out once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def measures(text: Column) -> Column:
    """All counts of a text as one struct."""
    text = F.coalesce(text, F.lit(""))
    trimmed = F.btrim(text, F.lit(BLANKS))
    words = F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, "[ \\t\\n\\x0B\\f\\r]+"))
    lines = F.filter(F.split(text, "\n", -1), lambda line: F.btrim(line, F.lit(BLANKS)) != "")
    bare = lambda line: F.btrim(line, F.lit(BLANKS))

    def of(words: Column, lines: Column) -> Column:
        return F.struct(
            F.size(words).cast("bigint").alias("n_words"),
            F.char_length(F.array_join(words, "")).cast("bigint").alias("word_chars"),
            F.regexp_count(text, F.lit("[#*$%&|<>]")).cast("bigint").alias("n_symbols"),
            (F.size(lines) - F.size(F.array_distinct(lines))).cast("bigint").alias("n_dup_lines"),
            _repeat_words(words).alias("n_repeat_words"),
            F.size(F.filter(words, lambda w: F.lower(w).isin(*STOP_WORDS))).cast("bigint").alias("n_stop_words"),
            F.regexp_count(text, F.lit("!(?=[ \\t\\n\\x0B\\f\\r]|$)")).cast("bigint").alias("n_exclaimed"),
            F.size(lines).cast("bigint").alias("n_lines"),
            F.size(F.filter(lines, lambda x: F.substring(bare(x), 1, 1).isin("-", "*", "•", "|"))).cast("bigint").alias("n_bullet_lines"),
            F.size(F.filter(lines, lambda x: bare(x).endswith("...") | bare(x).endswith("…"))).cast("bigint").alias("n_ellipsis_lines"),
        )

    return _let(F.struct(words.alias("w"), lines.alias("l")), lambda s: of(s["w"], s["l"]))


def failed(rules=RULES, of="measures") -> Column:
    """The names of the rules that a struct column of measures breaks."""
    checks = []
    for rule in rules:
        value = F.expr(re.sub(r"\b(n_\w+|word_chars)\b", rf"{of}.\1", rule.measure))
        bad = F.lit(False)
        if rule.least is not None:
            bad = bad | (value < rule.least)
        if rule.most is not None:
            bad = bad | (value > rule.most)
        checks.append(F.when(bad, F.lit(rule.name)))
    return F.filter(F.array(*checks), lambda name: name.isNotNull())


def judge(docs: DataFrame, rules=RULES, id_col="doc_id", text_col="text") -> DataFrame:
    """Per row: id, every measure, ``failed`` rules and ``kept``.

    Only the id and the text are read; a null id is returned as null.
    """
    measured = docs.select(F.col(id_col).alias("doc_id"), measures(F.col(text_col)).alias("measures"))
    return measured.withColumn("failed", failed(rules)).select(
        "doc_id", "measures.*", "failed", (F.size("failed") == 0).alias("kept")
    )


def keep(docs: DataFrame, rules=RULES, text_col="text") -> DataFrame:
    """The rows that break no rule, with their columns as they were.

    The name ``quality_rules__measures`` is used on the way.
    """
    # a generated column is worked out once, while the filter would repeat a projected one per rule
    measured = docs.select("*", F.explode(F.array(measures(F.col(text_col)))).alias("quality_rules__measures"))
    return measured.filter(F.size(failed(rules, "quality_rules__measures")) == 0).drop("quality_rules__measures")
