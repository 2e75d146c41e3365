"""Shards by extendible hashing: a directory over the leading bits of a hash.

Rows go by the bits of the md5 of their key. A bucket is a prefix of bits; one that holds more bytes
than the limit is split on the next bit, all others (and single rows) stay as they are. Only sizes by prefix are
gathered, never rows. Rows that share all ``MOST_BITS`` bits (repeated keys) cannot be split
that way: such a bucket gets numbered overflow pages, each within the limit.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from feedwell.llm.shared import Scratch

#: Bits of the hash that the directory may use.
MOST_BITS = 56
#: Bits that are looked at in one pass over the sizes.
STEP_BITS = 12


def key_bits(key) -> F.Column:
    """The first 56 bits of the md5 of a key (null: the empty text), as a number."""
    return F.conv(F.substring(F.md5(F.coalesce(F.col(key).cast("string"), F.lit(""))), 1, 14), 16, 10).cast("long")


def _sizes(rows: DataFrame, depth: int) -> DataFrame:
    """Bytes and rows by the first ``depth`` bits."""
    cell = F.shiftright("bits", MOST_BITS - depth)
    return rows.groupBy(cell.alias("cell")).agg(F.sum("bytes").alias("bytes"), F.count("*").alias("n"))


def directory(rows: DataFrame, limit: int) -> DataFrame:
    """The buckets of ``rows`` (bits, bytes): depth, prefix, bytes, n; together they hold every row once.

    Each pass sums the sizes by STEP_BITS more bits and rolls them up; the first prefix on the way
    down that fits is a bucket. Only what lies in prefixes that still do not fit is summed again.
    """
    found, depth, rest = None, 0, rows
    while True:
        low, depth = depth, min(depth + STEP_BITS, MOST_BITS)
        depths = F.explode(F.sequence(F.lit(low), F.lit(depth)))
        cells = _sizes(rest, depth).withColumn("depth", depths)
        cells = cells.withColumn("prefix", F.expr(f"shiftright(cell, {depth} - depth)"))
        sums = cells.groupBy("depth", "prefix").agg(F.sum("bytes").alias("bytes"), F.sum("n").alias("n"))
        end = F.col("depth") == depth
        over = (F.col("bytes") > limit) & (F.col("n") > 1)
        # A bucket fits, or has no bits left, and its parent did not fit.
        parent = sums.filter(over).select((F.col("depth") + 1).alias("depth"), F.col("prefix").alias("above"))
        child = sums.withColumn("above", F.shiftright("prefix", 1))
        last = depth == MOST_BITS
        fits = child.filter(~over | (end & F.lit(last)))
        top = fits.filter(F.col("depth") == low)
        buckets = fits.join(parent, ["depth", "above"], "left_semi").unionByName(top).drop("above")
        found = buckets if found is None else found.unionByName(buckets)
        large = sums.filter(over & end).select(F.col("prefix").alias("cell"))
        if last or large.isEmpty():
            return found
        cell = F.shiftright("bits", MOST_BITS - depth)
        rest = rest.withColumn("cell", cell).join(large, "cell", "left_semi").drop("cell")


def assign_shards(
    docs: DataFrame, limit: int, key: str = "doc_id", text: str = "text", scratch: Scratch | None = None,
) -> DataFrame:
    """Key, bytes (UTF-8 bytes of the text, null: 0), shard name and depth of every row.

    The name is the bucket's bits, or ``all`` for the only bucket, with ``+n`` for an overflow page.
    A row larger than the limit has a bucket or a page of its own. Repeated rows count each; an empty table
    gives no rows; other columns take no part. With ``scratch`` texts are read once, for their lengths.
    """
    rows = docs.select(
        F.col(key).alias("key"), F.coalesce(F.octet_length(text), F.lit(0)).cast("long").alias("bytes"),
        key_bits(key).alias("bits"),
    )
    rows = rows if scratch is None else scratch.result(rows, "keyed")
    buckets = directory(rows.select("bits", "bytes"), limit)
    buckets = buckets.select("depth", "prefix", ((F.col("bytes") > limit) & (F.col("n") > 1)).alias("over"))
    depths = [r.depth for r in buckets.select("depth").distinct().collect()]  # MOST_BITS + 1 at most
    # A bucket's prefix at each depth that occurs: an equality join, whatever the depth.
    levels = F.explode(F.array(*[F.lit(n) for n in depths])) if depths else F.lit(0)
    placed = rows.withColumn("depth", levels)
    placed = placed.withColumn("prefix", F.expr(f"shiftright(bits, {MOST_BITS} - depth)"))
    placed = placed.join(buckets, ["depth", "prefix"])
    name = F.when(F.col("depth") == 0, "all").otherwise(
        F.expr(f"substring(lpad(bin(bits), {MOST_BITS}, '0'), 1, depth)"))
    fitting = placed.filter("not over").withColumn("shard", name)
    # Only rows with equal bits are here. Two pages' worth of running bytes never share a page.
    pages = Window.partitionBy("bits").orderBy("bytes", "key").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("bytes").over(pages), F.lit(0))
    alone = F.col("bytes") > limit // 2
    page = F.when(alone, F.concat(F.lit("r"), F.row_number().over(Window.partitionBy("bits").orderBy("bytes", "key"))))
    page = page.otherwise(F.floor(before / (limit - limit // 2)).cast("string"))
    paged = placed.filter("over").withColumn("shard", F.concat(name, F.lit("+"), page))
    out = fitting.unionByName(paged)
    return out.select(F.col("key").alias(key), "bytes", "shard", F.col("depth").cast("int").alias("depth"))
