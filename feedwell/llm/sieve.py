"""Rows that may have one of many keys, told apart where they lie, so that a join moves no others."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits for each key, and at most for all: 16 MB go to every executor.
BITS, MOST = 16, 1 << 27
#: Bits of one bitmap (fixed value of Spark's bitmap functions).
BITMAP = 1 << 15


def sieve(rows: DataFrame, key: Column, keys: DataFrame, hashes: str) -> tuple[DataFrame, DataFrame]:
    """The rows that may have one of the keys, and those that surely have none.

    ``key`` is a 64-bit hash of a row's key, ``hashes`` the column of ``keys`` that holds the same hashes; null is
    no key. One bit per hash is kept, so about one row in twenty is taken for a match by chance, and more of them
    beyond 8 million keys: an exact join has to follow. The keys are counted at once, rows are read later.
    """
    bits = min(MOST, max(BITMAP, 1 << (BITS * keys.count()).bit_length()))

    def bit(value: Column) -> Column:
        return F.pmod(value, F.lit(bits))

    # Names that no column of the rows has.
    bucket, bitmap = (max(rows.columns, key=len) + end for end in ("_bucket", "_bitmap"))
    places = keys.filter(F.col(hashes).isNotNull()).select(bit(F.col(hashes)).alias("bit"))
    places = places.select(F.floor(F.col("bit") / BITMAP).alias(bucket), (F.col("bit") % BITMAP).alias("at"))
    bitmaps = places.repartition(bucket).groupBy(bucket).agg(F.bitmap_construct_agg("at").alias(bitmap))
    at = bit(key) % BITMAP
    byte = F.conv(F.hex(F.col(bitmap).substr((F.floor(at / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    met = F.coalesce(byte.bitwiseAND(F.pow(F.lit(2), at % 8).cast("int")) != 0, F.lit(False))
    known = rows.withColumn(bucket, F.floor(bit(key) / BITMAP)).join(F.broadcast(bitmaps), bucket, "left")
    return known.filter(met).select(rows.columns), known.filter(~met).select(rows.columns)
