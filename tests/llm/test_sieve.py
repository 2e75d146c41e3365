"""The sieve before joins, and what the operators that use it still move."""

import pytest
from pyspark.sql import functions as F

from feedwell.llm import sieve as module
from feedwell.llm.keep_one import keep_one
from feedwell.llm.shared import Scratch
from feedwell.llm.sieve import sieve


@pytest.mark.parametrize("most", [module.BITMAP, module.MOST])
@pytest.mark.parametrize("keys", [[], [5], [None, 5, 5, 7], list(range(0, 9000, 3))])
def test_no_key_is_lost_and_every_row_is_on_one_side(spark, make_docs, monkeypatch, keys, most):
    monkeypatch.setattr(module, "MOST", most)
    rows = [*range(9000), 5, 5, None, None, -1]
    docs = make_docs([(n, f"t{n}") for n in rows]).withColumn("hash", F.xxhash64("doc_id"))
    of_keys = spark.createDataFrame([(k,) for k in keys], "k long").select(F.when(F.col("k").isNotNull(), F.xxhash64("k")).alias("h"))
    met, sure = sieve(docs.withColumn("hash", F.when(F.col("doc_id").isNotNull(), F.col("hash"))), F.col("hash"), of_keys, "h")
    assert met.columns == sure.columns == docs.columns
    a, b = ([r.doc_id for r in d.select("doc_id").collect()] for d in (met, sure))
    assert sorted([*a, *b], key=repr) == sorted(rows, key=repr)
    wanted = {k for k in keys if k is not None}
    assert not wanted & set(b) and None not in a
    assert len(set(a) - wanted) <= (0.12 * len(rows) if most == module.MOST else len(rows) * len(wanted) / module.BITMAP * 1.5)


def test_rows_without_a_copy_stay_where_they_are(spark, make_docs):
    rows = [*((n, " ".join(f"w{n}x{k}" for k in range(20))) for n in range(300)), (900, " ".join(f"w7x{k}" for k in range(20))), (901, None)]
    docs = make_docs(rows)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        with Scratch(spark) as scratch:
            out = keep_one(docs, scratch)
        assert sorted(r.doc_id for r in out.select("doc_id").collect()) == [*range(300), 901]
        # One side of the result reads the documents and deals them to no other task.
        found = out._jdf.queryExecution().optimizedPlan()
        sides = [found.children().apply(n).toString() for n in range(found.children().size())]
        assert found.nodeName() == "Union" and len(sides) == 2 and sum("LeftAnti" not in side for side in sides) == 1
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
