"""Personal data: patterns propose spans, checks confirm them, context adjusts a score.

Everything is built-in functions.  Positions count code points from 0, ends are
exclusive.  Each kind is matched leftmost and without overlaps on its own, over
the whole text; a match that fails its check is dropped and not tried again
shorter.  Spans of different kinds may overlap.  A null text has no spans.

The patterns only start where a run of their characters starts (or where the
last match of the kind ended) and never give characters back, so a text of one
long run takes linear time.  They match the same strings as the plain forms.
"""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_LOCAL = "[A-Za-z0-9._%+-]"
_NAME = "[A-Za-z0-9-]"

_SPAN = "struct<kind:string,start:int,end:int,hit:string,score:double>"


def _digits(hit: Column) -> Column:
    return F.regexp_replace(hit, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether the check digit of a string of digits is right."""
    n = F.length(digits)

    def add(total: Column, i: Column) -> Column:
        digit = F.substring(digits, n - i + 1, F.lit(1)).cast("int")
        twice = digit * 2
        return total + F.when(i % 2 == 1, digit).otherwise(F.when(twice > 9, twice - 9).otherwise(twice))

    return (n > 0) & (F.aggregate(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), F.lit(0), add) % 10 == 0)


def mod97(code: Column) -> Column:
    """Whether an account number, letters as 10 to 35 and its first four moved to the end, leaves 1."""
    bare = F.replace(code, F.lit(" "), F.lit(""))
    turned = F.concat(F.substr(bare, F.lit(5)), F.substring(bare, 1, 4))

    def add(rest: Column, i: Column) -> Column:
        char = F.substring(turned, i, F.lit(1))
        value = F.ascii(char)
        return F.when(value >= 65, (rest * 100 + value - 55) % 97).otherwise((rest * 10 + value - 48) % 97)

    size = F.length(turned)
    return (size > 4) & (F.aggregate(F.sequence(F.lit(1), F.greatest(size, F.lit(1))), F.lit(0), add) == 1)


def _is_address(hit: Column) -> Column:
    def fits(part: Column) -> Column:
        number = F.ltrim(part, F.lit("0"))
        return (number == "") | F.when(F.length(number) > 3, F.lit(False)).otherwise(
            F.concat(F.lit("0"), F.substring(number, 1, 3)).cast("int") <= 255
        )

    return F.forall(F.split(hit, "\\."), fits)


@dataclass(frozen=True)
class Kind:
    """``base`` kinds stay whatever their score; the others need ``THRESHOLD``.

    ``hint`` is a string that every match contains, to skip texts without it.
    """

    name: str
    pattern: str
    base: bool
    confirm: object
    confirmed: float
    context: str
    hint: str | None = None


PROPOSED, IN_CONTEXT, THRESHOLD = 0.3, 0.35, 0.6
#: Characters before a span in which context words count.
REACH = 40

KINDS = (
    Kind(
        "email",
        rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@{_NAME}++(?:\.{_NAME}++)++",
        True,
        lambda hit: F.lit(True),
        0.5,
        "(?i)mail|contact|kontakt|correo|courriel",
        "@",
    ),
    Kind(
        "ip",
        r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
        True,
        _is_address,
        0.3,
        "(?i)address|host|server|\\bip\\b",
        ".",
    ),
    Kind(
        "card",
        r"[0-9](?:[ -]?[0-9]){11,}+",
        True,
        lambda hit: (F.length(_digits(hit)) <= 19) & luhn(_digits(hit)),
        0.4,
        "(?i)card|karte|carte|tarjeta|visa",
    ),
    Kind(
        "phone",
        r"\+[0-9][ ().0-9-]+[0-9]",
        True,
        lambda hit: F.length(_digits(hit)).between(9, 15),
        0.3,
        "(?i)phone|call|tel|mobil|llame",
        "+",
    ),
    Kind(
        "iban",
        r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
        False,
        mod97,
        0.4,
        "(?i)iban|account|konto|compte|cuenta",
    ),
    Kind(
        "secret",
        r"(?<![A-Za-z0-9])[0-9A-Fa-f]{32,}+(?![A-Za-z0-9])",
        False,
        lambda hit: hit.rlike("[0-9]") & hit.rlike("[A-Fa-f]"),
        0.1,
        "(?i)token|secret|passw|key",
    ),
)


def _placed(text: Column, hits: Column, pattern: str) -> Column:
    """Start and end of each hit, from the lengths of the pieces between hits.

    Blocks of hits are summed first, so many hits in a text stay near linear.
    """
    block = 128
    pieces = F.split(text, pattern, -1)
    sized = F.zip_with(
        F.slice(pieces, F.lit(1), F.size(hits)),
        hits,
        lambda gap, hit: F.struct(F.length(gap).alias("gap"), F.length(hit).alias("size"), hit.alias("hit")),
    )

    def total(xs: Column) -> Column:
        return F.aggregate(xs, F.lit(0), lambda n, x: n + x["gap"] + x["size"])

    def run(xs: Column, begin: Column) -> Column:
        return F.aggregate(
            xs,
            F.struct(begin.alias("at"), F.array().cast("array<struct<start:int,end:int,hit:string>>").alias("out")),
            lambda acc, x: F.struct(
                (acc["at"] + x["gap"] + x["size"]).alias("at"),
                F.concat(
                    acc["out"],
                    F.array(
                        F.struct(
                            (acc["at"] + x["gap"]).alias("start"),
                            (acc["at"] + x["gap"] + x["size"]).alias("end"),
                            x["hit"].alias("hit"),
                        )
                    ),
                ).alias("out"),
            ),
            lambda acc: acc["out"],
        )

    def blocks(xs: Column) -> Column:
        parts = F.transform(
            F.sequence(F.lit(0), F.floor((F.size(xs) - 1) / block).cast("int")),
            lambda k: F.slice(xs, k * block + 1, F.lit(block)),
        )
        return _let(parts, lambda p: _let(begins(p), lambda b: F.flatten(F.zip_with(p, b, run))))

    def begins(parts: Column) -> Column:
        return F.aggregate(
            parts,
            F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("out")),
            lambda acc, p: F.struct(
                (acc["at"] + total(p)).alias("at"), F.concat(acc["out"], F.array(acc["at"])).alias("out")
            ),
            lambda acc: acc["out"],
        )

    return _let(sized, lambda xs: F.when(F.size(xs) <= block, run(xs, F.lit(0))).otherwise(blocks(xs)))


def _let(value: Column, body) -> Column:
    """``body(value)`` with the value worked out once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _spans(text: Column, hits: Column, kind: Kind) -> Column:
    def scored(x: Column) -> Column:
        before = F.greatest(x["start"] - REACH, F.lit(0))
        near = F.substring(text, before + 1, x["start"] - before).rlike(kind.context)
        # a hit that is not confirmed has no score
        alone = PROPOSED + kind.confirmed
        score = F.when(kind.confirm(x["hit"]), F.when(near, min(alone + IN_CONTEXT, 1.0)).otherwise(alone))
        return F.struct(
            F.lit(kind.name).alias("kind"),
            x["start"].alias("start"),
            x["end"].alias("end"),
            x["hit"].alias("hit"),
            score.alias("score"),
        )

    good = (lambda s: s["score"].isNotNull()) if kind.base else (lambda s: s["score"] >= THRESHOLD)
    found = F.filter(F.transform(_placed(text, hits, kind.pattern), scored), good)
    return F.when(F.size(hits) > 0, found).otherwise(F.array()).cast(f"array<{_SPAN}>")


def spans(text: Column, kinds=KINDS) -> Column:
    """All spans of a text by start, then in the order of ``kinds``."""
    text = F.coalesce(text, F.lit(""))

    def hits(kind: Kind) -> Column:
        every = F.regexp_extract_all(text, F.lit(kind.pattern), 0)
        return every if kind.hint is None else F.when(text.contains(kind.hint), every).otherwise(F.array().cast("array<string>"))

    def ranked(k: int, kind: Kind, hit: Column) -> Column:
        return F.transform(
            _spans(text, hit, kind),
            lambda s: F.struct(s["start"].alias("start"), F.lit(k).alias("rank"), s.alias("span")),
        )

    found = F.struct(*[hits(kind).alias(kind.name) for kind in kinds])
    return _let(
        found,
        lambda h: F.when(
            sum((F.size(h[k.name]) for k in kinds), F.lit(0)) > 0,
            F.transform(
                F.array_sort(F.concat(*[ranked(i, kind, h[kind.name]) for i, kind in enumerate(kinds)])),
                lambda x: x["span"],
            ),
        ).otherwise(F.array().cast(f"array<{_SPAN}>")),
    )


def find(docs: DataFrame, kinds=KINDS, id_col="doc_id", text_col="text") -> DataFrame:
    """Per row: id and ``spans``, an array of kind, start, end, hit and score."""
    return docs.select(F.col(id_col).alias("doc_id"), spans(F.col(text_col), kinds).alias("spans"))


def redacted(text: Column, found: Column) -> Column:
    """The text with each span replaced by its kind; overlapping spans become the first one's."""

    def step(acc: Column, s: Column) -> Column:
        inside = s["start"] < acc["at"]
        return F.struct(
            F.greatest(acc["at"], s["end"]).alias("at"),
            F.when(inside, acc["out"])
            .otherwise(
                F.concat(
                    acc["out"],
                    F.substring(text, acc["at"] + 1, s["start"] - acc["at"]),
                    F.lit("<"),
                    F.upper(s["kind"]),
                    F.lit(">"),
                )
            )
            .alias("out"),
        )

    return F.when(F.size(found) == 0, text).otherwise(
        F.aggregate(
            found,
            F.struct(F.lit(0).alias("at"), F.lit("").alias("out")),
            step,
            lambda acc: F.concat(acc["out"], F.substr(text, acc["at"] + 1)),
        )
    )


def redact(docs: DataFrame, kinds=KINDS, text_col="text") -> DataFrame:
    """All rows and columns, the text without its spans; a null text stays null.

    The name ``pii__spans`` is used on the way.
    """
    found = docs.withColumn("pii__spans", spans(F.col(text_col), kinds))
    return found.withColumn(text_col, redacted(F.col(text_col), F.col("pii__spans"))).drop("pii__spans")
