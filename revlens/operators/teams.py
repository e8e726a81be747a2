"""Team and role labels by author and date."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from revlens.session import broadcast_if_small


def rule_periods(author_rules: DataFrame) -> DataFrame:
    """Rules resolved into disjoint periods per author: ``author, start, stop, team, role``.

    An author's time line is cut wherever a rule begins or ends; in each piece
    the last rule that covers it wins.  The work grows with the rule table, which
    people write, and leaves at most one match per commit.
    """
    cuts = author_rules.select(
        "author",
        F.explode(F.array(F.lit(None).cast("date"), F.col("valid_from"), F.col("valid_to"))).alias("start"),
    ).distinct()
    line = Window.partitionBy("author").orderBy(F.col("start").asc_nulls_first())
    pieces = cuts.withColumn("stop", F.lead("start").over(line))
    covers = (F.col("valid_from").isNull() | (F.col("start") >= F.col("valid_from"))) & (
        F.col("valid_to").isNull() | F.col("start").isNull() | (F.col("start") < F.col("valid_to"))
    )
    winner = F.max_by(F.struct("team", "role"), F.col("seq")).alias("winner")
    return (
        pieces.join(author_rules, "author")
        .filter(covers)
        .groupBy("author", "start", "stop")
        .agg(winner)
        .select("author", "start", "stop", "winner.*")
    )


def assign_team_role(commits: DataFrame, author_rules: DataFrame) -> DataFrame:
    """Label commits; those no rule matches get empty labels.

    The resolved rules are broadcast when they are proven small, so commits are
    not shuffled; a larger rule table joins on the author, where adaptive
    execution splits an author with very many commits.
    """
    p = broadcast_if_small(rule_periods(author_rules)).alias("p")
    c = commits.alias("c")
    matches = (
        (F.col("c.author") == F.col("p.author"))
        & (F.col("p.start").isNull() | (F.col("c.date") >= F.col("p.start")))
        & (F.col("p.stop").isNull() | (F.col("c.date") < F.col("p.stop")))
    )
    label = {name: F.coalesce(f"p.{name}", F.lit("")).alias(name) for name in ("team", "role")}
    return c.join(p, matches, "left").select(*[label.get(name, F.col(f"c.{name}")) for name in commits.columns])
