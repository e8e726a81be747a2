"""Mixing sources to target weights by entropy balancing.

1. Sources, in the order of their code points with null last, get the weights in turn
   and share all words by them.  A source takes at most ``most`` times its words; what is
   over is shared by weight among the others, until none is above.
2. A document of size s is taken at the rate min(most, exp(lambda x)), where x is s by the
   mean size of its source.  Of all rates up to ``most`` whose words add up to the target,
   these are nearest to 1 in relative entropy.  The multipliers minimise a convex dual
   whose gradient is the words taken less the target; sources share no term of it.
3. All sources are solved at once by Newton steps over the table of (source, size, number of
   documents), each within the interval that the signs of former gradients leave.
   Sums are of fixed-point integers, so they do not depend on the order of rows.
   A source whose target is all it may take has the rate ``most`` throughout.
4. Rates are rounded into copies: the whole part, and one more where a number from the
   hash of id and text lies low enough against the rest.  How low is found for each source by
   counting words by the digits of that number, so that the words taken come as near to
   the target as one document allows (all rows of equal id and text count as one).

Tables per source are written, so a join with them broadcasts or shuffles by their true size.
Nothing is held whole: sources, sizes and multipliers are tables, and a source of any size
is added up in parts first.

Results: one row per document, repeated rows included; rows equal in id and text are taken
equally often.  Words are runs of characters other than ASCII white space; a null or wordless
text has size 0 and is not taken.  Documents without a source form one.  The same rows give
the same result in any order.  An empty table gives no rows.  Other columns are left out.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from revlens.llm.ranks import ranked
from revlens.session import materialize

WEIGHTS = (1, 2, 3)
MOST = 3
STEPS = 60
#: Parts of a word in which taken words are added up.
FIXED = 1024
#: Bits of the number by which a document gets one more copy, and of a digit of it.
BITS, DIGIT = 29, 10


def sized(docs: DataFrame, id_col="doc_id", text_col="text", source_col="source", seed=13) -> DataFrame:
    """``doc_id``, ``source``, ``size`` and ``toss``, a number from 0 to 1 from a hash of id and text."""
    source, text = F.col(source_col).cast("string"), F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    doc_id = F.col(id_col).cast("long")
    return docs.select(
        doc_id.alias("doc_id"),
        # null after all others, and unlike any of them
        F.when(source.isNull(), "1").otherwise(F.concat(F.lit("0"), source)).alias("source"),
        F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("size"),
        (F.shiftrightunsigned(F.xxhash64(doc_id, text, F.lit(seed)), 11).cast("double") / 2.0**53).alias("toss"),
    )


def weighted(sources: DataFrame, weights=WEIGHTS) -> DataFrame:
    """Sources with the weights in turn, by their order."""
    cycle = F.array(*[F.lit(w).cast("long") for w in weights])
    placed = ranked(sources.withColumn("key", F.col("source")), sources.count())
    return placed.withColumn("weight", F.get(cycle, ((F.col("rank") - 1) % len(weights)).cast("int"))).drop("key", "rank")


def targets(sources: DataFrame, most=MOST) -> DataFrame:
    """``target`` words of every source from ``source_size`` and ``weight``.

    Each round sets the sources that would get more than ``most`` times their words to that,
    and works out anew what a unit of weight gets; three numbers reach the driver.
    """
    cap = F.col("source_size") * most
    total = sources.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0]
    rest, shares, full = total, sources.agg(F.coalesce(F.sum("weight"), F.lit(0))).first()[0], -1
    while shares:
        over = F.col("weight") * F.lit(rest).cast("double") / shares >= cap
        held, unheld, n = sources.agg(
            F.coalesce(F.sum(F.when(over, cap)), F.lit(0)),
            F.coalesce(F.sum(F.when(~over, F.col("weight"))), F.lit(0)),
            F.count_if(over),
        ).first()
        if n == full:
            break
        rest, shares, full = total - held, unheld, n
    if not shares:
        return sources.withColumn("target", cap.cast("double"))
    return sources.withColumn("target", F.least(cap.cast("double"), F.col("weight") * F.lit(rest).cast("double") / shares))


def rate(size: Column, most=MOST) -> Column:
    tilted = F.least(F.lit(float(most)), F.exp(F.col("tilt") * size / F.col("scale")))
    return F.when(F.col("full"), F.lit(float(most))).otherwise(tilted)


def solved(sources: DataFrame, sizes: DataFrame, most=MOST, steps=STEPS) -> DataFrame:
    """Sources with ``tilt``, the multiplier of their size by the mean ``scale``, and ``full`` where all is taken.

    ``sizes`` has the number of documents per source and size.  Every Newton step is one pass over it.
    """
    none = F.lit(None).cast("double")
    state = sources.withColumns(
        {
            "scale": F.col("source_size") / F.greatest("n_docs", F.lit(1)),
            "full": F.col("target") >= F.col("source_size") * most,
            "tilt": F.lit(0.0),
            "low": none,
            "high": none,
        }
    ).withColumn("done", F.col("full"))
    state = materialize(state, "tilts")
    x = F.col("size") / F.col("scale")
    words = F.col("n") * F.col("size") * rate(F.col("size"), most)
    slope = F.when(rate(F.col("size"), most) < most, words * x).otherwise(0.0)
    fixed = lambda value: F.sum(F.round(value * FIXED).cast("decimal(38,0)")).cast("double") / FIXED
    for _ in range(steps):
        if state.filter("not done").isEmpty():
            break
        sums = (
            sizes.join(state.filter("not done"), "source")
            .groupBy("source")
            .agg(fixed(words).alias("taken"), fixed(slope).alias("slope"))
        )
        over = F.col("taken") - F.col("target")
        moved = (
            state.join(sums, "source", "left")
            .withColumn("done", F.col("done") | F.coalesce(F.abs(over) <= 0.5 + 1e-9 * F.col("target"), F.lit(False)))
            .withColumn("low", F.when(over < 0, F.col("tilt")).otherwise(F.col("low")))
            .withColumn("high", F.when(over > 0, F.col("tilt")).otherwise(F.col("high")))
            .withColumn("newton", F.when(F.col("slope") > 0, F.col("tilt") - over / F.col("slope")))
        )
        inside = (
            F.col("newton").isNotNull()
            & (F.col("low").isNull() | (F.col("newton") > F.col("low")))
            & (F.col("high").isNull() | (F.col("newton") < F.col("high")))
        )
        following = (
            F.when(F.col("done"), F.col("tilt"))
            .when(inside, F.col("newton"))
            .when(F.col("low").isNull(), F.col("tilt") * 2 - 1)
            .when(F.col("high").isNull(), F.col("tilt") * 2 + 1)
            .otherwise((F.col("low") + F.col("high")) / 2)
        )
        state = materialize(moved.withColumn("tilt", following).drop("newton", "taken", "slope"), "tilts")
    return state.select(*sources.columns, "scale", "full", "tilt")


def _copies(documents: DataFrame, sources: DataFrame, most: int) -> DataFrame:
    """Documents with their source's columns, the ``whole`` part of their rate and the number ``lot`` that decides on one more."""
    joined = documents.join(sources, "source").withColumn("rate", rate(F.col("size"), most))
    part = F.col("rate") - F.floor("rate")
    return joined.withColumn("whole", F.floor("rate")).withColumn(
        "lot", F.when(part > 0, F.floor((F.col("toss") - part + 1) * 2.0**BITS).cast("long"))
    )


def cuts(documents: DataFrame, sources: DataFrame, most=MOST) -> DataFrame:
    """Sources with ``cut``: a document gets one more copy if its ``lot`` is below.

    The cut is found digit by digit, the leading one first: documents that agree with the digits so
    far are added up by the next one, and the digit in which the target is reached is kept.
    """
    digits = -(-(BITS + 1) // DIGIT)
    whole = _copies(documents, sources, most).groupBy("source").agg(F.sum(F.col("whole") * F.col("size")).alias("whole_words"))
    state = sources.join(whole, "source", "left").withColumns(
        {"cut": F.lit(0).cast("long"), "missing": F.col("target") - F.coalesce("whole_words", F.lit(0))}
    )
    state = materialize(state.drop("whole_words"), "cuts")
    for place in range(digits - 1, -1, -1):
        unit = 1 << (DIGIT * place)
        lots = _copies(documents, state, most).filter(F.col("lot").isNotNull())
        digit = F.floor((F.col("lot") - F.col("cut")) / unit).cast("long")
        by_digit = (
            lots.filter((F.col("lot") >= F.col("cut")) & (F.col("lot") < F.col("cut") + unit * (1 << DIGIT)))
            .groupBy("source", digit.alias("digit"))
            .agg(F.sum("size").alias("words"))
        )
        up_to = Window.partitionBy("source").orderBy("digit")
        reached = (
            by_digit.withColumn("above", F.sum("words").over(up_to))
            .join(state.select("source", "missing"), "source")
            .withColumn("passed", F.col("above") <= F.col("missing"))
            .groupBy("source")
            .agg(
                F.max(F.when(F.col("passed"), F.col("above"))).alias("taken"),
                F.min(F.when(~F.col("passed"), F.struct("digit", "words"))).alias("next"),
                F.max("digit").alias("last"),
            )
        )
        found = F.coalesce(F.col("next.digit"), F.col("last") + 1, F.lit(0))
        if not place:  # one more document where that is nearer
            left = F.col("missing") - F.coalesce("taken", F.lit(0))
            found += F.when(2 * left > F.col("next.words"), 1).otherwise(0)
        state = materialize(
            state.join(reached, "source", "left")
            .withColumn("cut", F.col("cut") + found * unit)
            .withColumn("missing", F.col("missing") - F.coalesce("taken", F.lit(0)))
            .drop("taken", "next", "last"),
            "cuts",
        )
    return state.drop("missing")


def mix(
    docs: DataFrame,
    weights=WEIGHTS,
    most=MOST,
    id_col="doc_id",
    text_col="text",
    source_col="source",
    seed=13,
) -> DataFrame:
    """doc_id, size, source_size, target, rate and taken (words, repeats counted) of every document."""
    documents = materialize(sized(docs, id_col, text_col, source_col, seed), "sized")
    sizes = materialize(documents.groupBy("source", "size").agg(F.count(F.lit(1)).alias("n")), "sizes")
    sources = sizes.groupBy("source").agg(F.sum(F.col("n") * F.col("size")).alias("source_size"), F.sum("n").alias("n_docs"))
    aimed = materialize(targets(materialize(weighted(sources, weights), "sources"), most), "targets")
    planned = cuts(documents, solved(aimed, sizes.filter("size > 0"), most), most)
    extra = F.coalesce(F.col("lot") < F.col("cut"), F.lit(False)).cast("long")
    return _copies(documents, planned, most).select(
        "doc_id", "size", "source_size", "target", "rate", ((F.col("whole") + extra) * F.col("size")).alias("taken")
    )
