"""Finding columns by header prefix.

Two forms of the same rules. A *header table* has one row per header (file,
ordinal, header) and may be of any size: each function below takes it through
partial + final hash aggregates, so a file holding a large share of all rows
costs no single task more than its share. A *header list* is one array per
sheet and is searched in place, without a shuffle.

Prefixes are parameters, so they become literals in the plan; there is no join
of headers to prefixes. Where each feed has its own, they are a table, which is
joined by equal beginnings (``resolve_targets``).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedwell.functions.names import key_text, marker_key, marker_text, prefix_key

_KEY = "__key"
_MARK = "__mark"


def _keyed(headers: DataFrame, by: Sequence[str], header: str, ordinal: str) -> DataFrame:
    return headers.select(*by, ordinal, header, key_text(header).alias(_KEY))


def _first_hits(hits: DataFrame, by: Sequence[str], header: str, ordinal: str) -> DataFrame:
    """The hit with the least ordinal per group; of equal ones the least header.

    The least ordinal is a hash aggregate; its few rows go back to the hits for the header.
    """
    least = hits.groupBy(*[F.col(c).alias(f"__by_{c}") for c in by]).agg(F.min(ordinal).alias("__least"))
    same = reduce(and_, [F.col(c).eqNullSafe(F.col(f"__by_{c}")) for c in by])
    held = hits.join(least, same & F.col(ordinal).eqNullSafe(F.col("__least")), "left_semi")
    ranked = Window.partitionBy(*by).orderBy(header)
    firsts = held.withColumn("__rank", F.row_number().over(ranked)).filter(F.col("__rank") == 1)
    return firsts.select(*by, ordinal, header)


def resolve_headers(
    headers: DataFrame, targets: Mapping[str, str], by: Sequence[str],
    header: str = "header", ordinal: str = "ordinal",
) -> DataFrame:
    """First header per file and target whose key starts with the target's prefix.

    ``targets`` maps a canonical name to a header prefix. Gives one row
    (by, target, ordinal, header) per resolved target.
    """
    found = {name: F.col(_KEY).startswith(prefix_key(p)) for name, p in targets.items()}
    names = F.array_compact(F.array(*[F.when(match, F.lit(name)) for name, match in found.items()]))
    keyed = _keyed(headers, by, header, ordinal).filter(reduce(or_, found.values()))
    hits = keyed.select(*by, ordinal, header, F.explode(names).alias("target"))
    return _first_hits(hits, [*by, "target"], header, ordinal).select(*by, "target", ordinal, header)


def resolve_headers_all(
    headers: DataFrame, prefixes: Sequence[str], by: Sequence[str],
    header: str = "header", ordinal: str = "ordinal",
) -> DataFrame:
    """Every header that matches a prefix, once per file.

    The list of a file is ordered by (``target_no``, ``ordinal``): prefix order
    first, then header order. The rows carry that order instead of a running
    number, which would need all of a file in one task.
    """
    keys = [prefix_key(p) for p in prefixes]
    target = F.coalesce(*[F.when(F.col(_KEY).startswith(k), F.lit(i)) for i, k in enumerate(keys)])
    return (
        _keyed(headers, by, header, ordinal)
        .select(*by, header, ordinal, target.alias("target_no"))
        .filter(F.col("target_no").isNotNull())
        .groupBy(*by, header)
        .agg(F.min("target_no").alias("target_no"), F.min(ordinal).alias(ordinal))
    )


def resolve_flag(
    headers: DataFrame, prefix: str, markers: Sequence[str], by: Sequence[str],
    header: str = "header", ordinal: str = "ordinal",
) -> DataFrame:
    """First header per file that starts with ``prefix`` and contains a marker."""
    hits = (
        headers.select(*by, ordinal, header, key_text(header).alias(_KEY), marker_text(header).alias(_MARK))
        .filter(_is_flag(F.col(_KEY), F.col(_MARK), prefix, markers))
    )
    return _first_hits(hits.select(*by, ordinal, header), by, header, ordinal)


def missing_columns(
    headers: DataFrame, targets: Mapping[str, str], by: Sequence[str], header: str = "header",
) -> DataFrame:
    """(by, target) for each required target that no header of the file matches.

    A file without any header is one row whose header is NULL, as ``list_headers`` gives it.
    """
    keyed = headers.select(*by, key_text(header).alias(_KEY))
    seen = keyed.groupBy(*by).agg(*[
        F.bool_or(F.col(_KEY).startswith(prefix_key(p))).alias(f"__seen_{i}")
        for i, p in enumerate(targets.values())
    ])
    absent = F.array(*[
        F.when(~F.col(f"__seen_{i}"), F.lit(name)) for i, name in enumerate(targets)
    ])
    return seen.select(*by, F.explode(F.array_compact(absent)).alias("target"))


def _is_flag(key: Column, mark: Column, prefix: str, markers: Sequence[str]) -> Column:
    has_marker = reduce(or_, [mark.contains(marker_key(m)) for m in markers])
    return key.startswith(prefix_key(prefix)) & has_marker


def first_position(keys: Column, prefix: str) -> Column:
    """Position (from 0) of the first key in a list that starts with ``prefix``; NULL if none."""
    p = prefix_key(prefix)
    return _first_true(F.transform(keys, lambda k: k.startswith(p)))


def flag_position(keys: Column, marks: Column, prefix: str, markers: Sequence[str]) -> Column:
    """Position (from 0) of the first flag header in a list; NULL if none."""
    return _first_true(F.zip_with(keys, marks, lambda k, m: _is_flag(k, m, prefix, markers)))


def _first_true(tests: Column) -> Column:
    return F.nullif(F.array_position(tests, F.lit(True)), F.lit(0)).cast("int") - 1


def resolve_targets(
    headers: DataFrame, targets: DataFrame, by: Sequence[str], feed: str = "feed",
    header: str = "header", ordinal: str = "ordinal",
) -> DataFrame:
    """As ``resolve_headers``, with the targets of each feed in a table (feed, target, prefix) of any size.

    ``by`` are the columns of a file, among them its feed. A header meets the prefixes of its feed by
    equal keys: for each length that the feed's prefixes have, what its key begins with. A prefix whose
    key is empty fails the job, as it would match everything.
    """
    keys = key_text("prefix")
    checked = F.when(keys != "", keys).otherwise(F.raise_error(F.concat(
        F.lit("prefix '"), F.coalesce("prefix", F.lit("")), F.lit("' is empty after normalisation and would match every name"))))
    wanted = targets.select(F.col(feed).alias("__feed"), "target", checked.alias("__start"))
    wanted = wanted.withColumn("__length", F.length("__start")).distinct()
    lengths = wanted.groupBy("__feed").agg(F.collect_set("__length").alias("__lengths"))
    keyed = _keyed(headers, by, header, ordinal).join(lengths, F.col(feed).eqNullSafe(F.col("__feed"))).drop("__feed")
    fitting = F.filter("__lengths", lambda n: n <= F.length(_KEY))
    starts = keyed.select(*by, ordinal, header, _KEY, F.explode(fitting).alias("__cut"))
    starts = starts.withColumn("__begin", F.left(_KEY, F.col("__cut")))
    same = F.col(feed).eqNullSafe(F.col("__feed")) & (F.col("__cut") == F.col("__length")) & (F.col("__begin") == F.col("__start"))
    hits = starts.join(wanted, same).select(*by, ordinal, header, "target")
    return _first_hits(hits, [*by, "target"], header, ordinal).select(*by, "target", ordinal, header)
