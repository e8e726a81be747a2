"""Checks on stored tables that the storage itself does not enforce."""

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from revlens import schema
from revlens.functions.messages import longer_than, utf16_length


# Bits of one bitmap of the built-in bitmap functions, and how many bitmaps a prefilter holds at most.
BITMAP_BITS = 32_768
BITMAPS = 1_024


def _spot(key_hash, bitmaps: int) -> Column:
    return F.pmod(key_hash, F.lit(bitmaps * BITMAP_BITS))


def suspects(df: DataFrame, keys, bitmaps: int = BITMAPS) -> DataFrame:
    """Rows whose keys may occur more than once; rows left out are surely unique.

    Only 8-byte hashes of the keys are shuffled, combined before.  Those that occur
    again are kept as bits of at most ``bitmaps`` bitmaps of 4 KB, a broadcast whose size
    is bounded whatever the table holds, and rows that miss them are dropped
    where they are read.  Null equals null.
    """
    key_hash = F.xxhash64(*keys)
    repeated = df.select(key_hash.alias("key_hash")).groupBy("key_hash").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    spot = _spot(F.col("key_hash"), bitmaps)
    maps = repeated.groupBy(F.floor(spot / BITMAP_BITS).alias("suspect_map")).agg(
        F.bitmap_construct_agg(spot % BITMAP_BITS).alias("suspect_bits")
    )
    here = _spot(key_hash, bitmaps)
    bit = here % BITMAP_BITS
    byte = F.conv(F.hex(F.substring("suspect_bits", F.floor(bit / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    rows = df.alias("rows")
    return (
        rows.join(F.broadcast(maps), F.floor(here / BITMAP_BITS) == F.col("suspect_map"))
        .filter(F.getbit(byte, (bit % 8).cast("int")) == 1)
        .select("rows.*")
    )


def unique_violations(df: DataFrame, keys, bitmaps: int = BITMAPS) -> DataFrame:
    """Keys that occur more than once.

    Keys that hold texts are grouped only where they are suspect, as shuffling all paths
    of a log costs far more than their hashes; numbers are as short as a hash.
    """
    keys = list(keys)
    rows = df.select(*keys)
    if any(isinstance(rows.schema[key].dataType, T.StringType) for key in keys):
        rows = suspects(rows, keys, bitmaps)
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).filter("copies > 1")


def length_violations(df: DataFrame, limits: dict[str, int], key="revision") -> DataFrame:
    """Values longer than their column allows: ``key, column_name, n_chars, max_chars``.

    All columns are checked in one pass.
    """

    def finding(name, limit):
        size = utf16_length(F.col(name)).alias("n_chars")
        return F.when(
            longer_than(F.col(name), limit),
            F.struct(F.lit(name).alias("column_name"), size, F.lit(limit).alias("max_chars")),
        )

    found = F.array_compact(F.array(*[finding(name, limit) for name, limit in limits.items()]))
    return df.select(key, F.explode(found).alias("v")).select(key, "v.*")


def table_violations(tables: dict[str, DataFrame]) -> DataFrame:
    """Repeated keys and over-long values of the stored tables, counted per table.

    Lengths are counted without a shuffle of rows; keys as by ``unique_violations``.
    """
    counts = []
    for name, df in tables.items():
        long = [F.when(longer_than(F.col(column), limit), 1).otherwise(0) for column, limit in schema.TEXT_LIMITS[name].items()]
        values = df.agg(F.lit(0).cast("bigint").alias("repeated_keys"), F.sum(sum(long, F.lit(0))).alias("long_values"))
        keys = unique_violations(df, schema.UNIQUE_KEYS[name]).agg(
            F.count(F.lit(1)).alias("repeated_keys"), F.lit(0).cast("bigint").alias("long_values")
        )
        counts.append(
            values.unionByName(keys)
            .agg(F.sum("repeated_keys").alias("repeated_keys"), F.coalesce(F.sum("long_values"), F.lit(0)).alias("long_values"))
            .select(F.lit(name).alias("table_name"), "repeated_keys", "long_values")
        )
    return reduce(DataFrame.unionByName, counts)
