"""One document of each group of similar texts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedwell.llm.jaccard import link_documents
from feedwell.llm.shared import Scratch
from feedwell.llm.sieve import sieve


def keep_one(
    docs: DataFrame, scratch: Scratch, width: int = 5, percent: int = 80, doc_id: str = "doc_id", text: str = "text",
) -> DataFrame:
    """The rows of ``docs`` without copies: of texts that links join, the row of the smallest id stays.

    Rows are linked by their texts, whatever their ids. A null id is the largest one; of several texts of
    one id in a group the least stays, and of equal rows one. Texts of one id that are not linked all
    stay, as do rows without a word. An empty table gives no rows; other columns go with their rows.

    Rows are told apart by their ids and 128 bits of their texts. The links are found by 64 bits; texts that
    share these and differ are left as they are.
    """
    # Names that no column of the documents has.
    place, digest = (max(docs.columns, key=len) + end for end in ("_place", "_digest"))
    keyed = docs.withColumns({place: F.xxhash64(text), digest: F.md5(text)})
    rows = keyed.filter(F.col(text).isNotNull()).groupBy(
        F.col(doc_id).alias("id"), F.col(place).alias("place"), F.col(digest).alias("digest")).agg(F.count("*").alias("times"))
    rows = scratch.table(rows)
    texts = keyed.filter(F.col(text).isNotNull()).select(F.col(place).alias("place"), F.col(text).alias("text"))
    linked = link_documents(texts, scratch, width, percent, doc_id="place")
    linked = linked.filter("n_shingles > 0").groupBy("doc_id").agg(F.min("component_id").alias("of")).withColumnRenamed("doc_id", "place")
    sure = rows.select("place", "digest").distinct().groupBy("place").count().filter("count = 1").select("place")
    members = scratch.table(rows.join(linked.join(sure, "place", "left_semi"), "place"))

    first = members.groupBy("of").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id")).alias("first"))
    own = members.join(first.select("of", F.col("first.id").alias("least")), "of").filter(F.col("id").eqNullSafe(F.col("least")))
    several = own.groupBy("of").count().filter("count > 1").select("of")
    rivals = scratch.table(own.join(several, "of", "left_semi").select("of", "id", "digest"))
    if not rivals.isEmpty():
        read, _ = sieve(keyed, F.xxhash64(digest), rivals.select(F.xxhash64("digest").alias("hash")).distinct(), "hash")
        read = read.join(rivals.select(F.col("digest").alias(digest)).distinct(), digest, "left_semi")
        read = read.select(F.col(digest).alias("digest"), F.col(text).alias("text")).distinct()
        least = rivals.join(read, "digest").groupBy("of").agg(F.min(F.struct("text", "digest")).alias("least"))
        winners = rivals.join(least.select("of", F.col("least.digest").alias("digest")), ["of", "digest"])
        losers = rivals.join(winners, ["of", "digest"], "left_anti").select("of", "digest")
        own = own.join(losers, ["of", "digest"], "left_anti")
    kept = scratch.table(own.select("id", "digest", "times"))

    key, of_text = place, f"{digest}_"
    same = F.col(doc_id).eqNullSafe(F.col(key)) & (F.col(digest) == F.col(of_text))
    gone = scratch.result(members.select("id", "digest").join(
        kept.select(F.col("id").alias("kept_id"), F.col("digest").alias("kept_digest")),
        F.col("id").eqNullSafe(F.col("kept_id")) & (F.col("digest") == F.col("kept_digest")), "left_anti").select(
            F.col("id").alias(key), F.col("digest").alias(of_text)), "gone")
    again = scratch.result(kept.filter("times > 1").select(F.col("id").alias(key), F.col("digest").alias(of_text)), "again")
    # Rows whose texts are in neither list stay where they are.
    named = gone.unionByName(again).select(F.xxhash64(of_text).alias("hash")).distinct()
    met, sure = sieve(keyed.drop(place), F.xxhash64(digest), named, "hash")
    left = met.join(gone, same, "left_anti")
    if not again.isEmpty():
        once = left.join(again, same, "left_semi").dropDuplicates([doc_id, digest])
        left = left.join(again, same, "left_anti").unionByName(once)
    return left.unionByName(sure).select(docs.columns)
