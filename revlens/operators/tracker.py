"""Issue-tracker documents: originals, links and single fields."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from revlens import rules
from revlens.session import group_for_join
from revlens.sources.readers import BLANKS


def docs_by_reference(docs: DataFrame, wanted: "str | DataFrame") -> DataFrame:
    """Documents of one reference, or of every reference in a table."""
    if isinstance(wanted, str):
        return docs.filter(F.col("reference") == wanted)
    return docs.join(wanted.select("reference"), "reference", "left_semi")


def original_document(docs: DataFrame, legacy=False) -> DataFrame:
    """One document per database and reference: most revisions, then earliest.

    Documents under one reference are conflict copies of each other.  The best
    one is an aggregate, combined before the shuffle, so a reference with very
    many copies is no hot spot.  ``legacy`` never considers the last of several.
    """
    named = docs.filter(F.btrim("reference", F.lit(BLANKS)) != "")
    if legacy:
        # Leaving one document out, the best is among the first two; picking those
        # is a group limit, which also works before the shuffle.
        order = Window.partitionBy("db", "reference").orderBy(_rank().desc())
        best_two = named.withColumn("place", F.row_number().over(order)).filter("place <= 2").drop("place")
        last = named.groupBy(F.col("db").alias("last_db"), F.col("reference").alias("last_reference")).agg(
            F.max("doc_id").alias("last_id"), F.count(F.lit(1)).alias("copies")
        )
        same = F.col("db").eqNullSafe(F.col("last_db")) & (F.col("reference") == F.col("last_reference"))
        named = (
            best_two.join(last, same)
            .filter((F.col("copies") == 1) | (F.col("doc_id") < F.col("last_id")))
            .select(*docs.columns)
        )
    kept = F.struct(*[c for c in docs.columns if c not in ("db", "reference")])
    best = named.groupBy("db", "reference").agg(F.max_by(kept, _rank()).alias("best"))
    return best.select("db", "reference", "best.*").select(*docs.columns)


def _rank():
    return F.struct(F.coalesce(F.size("revisions"), F.lit(0)), -F.col("doc_id"))


def _best(docs: DataFrame, kept: list[str]) -> DataFrame:
    """The ``kept`` fields of each reference's best document."""
    best = F.max_by(F.struct(*kept), _rank()).alias("best")
    return group_for_join(docs, F.col("reference")).agg(best).select("reference", "best.*")


def issue_links(
    issues: DataFrame, docs: DataFrame, db="features", replica=rules.FEATURES_REPLICA, view=rules.FEATURES_VIEW
) -> DataFrame:
    """Issues with an HTML link to their original document in one database, if there is one.

    Documents without a column ``db`` are taken to be of that database.
    """
    # Only the fields of a link travel; histories and the like do not.
    own = docs.filter(F.col("db") == db) if "db" in docs.columns else docs
    named = own.filter(F.btrim("reference", F.lit(BLANKS)) != "")
    originals = _best(named, ["name", "uniq_id", "doc_id"])
    link = F.format_string(
        f"<a href=Notes:///{replica}/{view}/%s>%s  %s</a>",
        F.coalesce("uniq_id", F.lit("NO-UniqID")),
        F.coalesce("reference", F.lit("NO-REFERENCE")),
        F.coalesce("name", F.lit("NO-NAME")),
    )
    return issues.join(originals, "reference", "left").select(
        "revision", "type", "reference", F.when(F.col("doc_id").isNotNull(), link).alias("link")
    )
