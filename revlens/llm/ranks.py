"""Ranks of the rows of a whole table, without a task that sees all of them."""

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revlens.session import materialize

#: Rows that one task sorts, on average.
SORTED_AT_ONCE = 20_000


def ranked(rows: DataFrame, n: int) -> DataFrame:
    """The rows with ``rank`` 1, 2, 3 ... by their column ``key``; ``n`` is their number, about.

    Rows are sorted by ranges of the key and written; the rows of the ranges before a
    range then shift the places within it.  Equal keys may fill one range.
    """
    ranges = max(1, math.ceil(n / SORTED_AT_ONCE))
    spread = rows.repartitionByRange(ranges, "key").sortWithinPartitions("key")
    held = materialize(spread.select("*", F.spark_partition_id().alias("range"), F.monotonically_increasing_id().alias("place")), "ranges")
    sizes = held.groupBy("range").agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("n")).orderBy("range").collect()
    before, shifts = 0, []
    for row in sizes:
        shifts.append((row["range"], before + 1 - row["first"]))
        before += row["n"]
    # a row per range of thousands of rows, so its size is known
    shift = rows.sparkSession.createDataFrame(shifts, "range int, shift long")
    return held.join(F.broadcast(shift), "range").withColumn("rank", F.col("place") + F.col("shift")).drop("range", "place", "shift")
