"""Language-model scores by lookups in shards, for tables that are not broadcast."""

import math
import os

from pyspark.sql import functions as F

from isoloom.llm import lm
from tests.llm.conftest import SMALL

LARGER = "/root/testdata/sf0.01/documents.parquet"


def shuffled(spark):
    """Bytes that all stages so far have written to shuffles."""
    sc, jvm = spark.sparkContext, spark.sparkContext._jvm
    sc._jsc.sc().listenerBus().waitUntilEmpty(30_000)
    stages = sc._jsc.sc().statusStore().stageList(None, False, False, sc._gateway.new_array(jvm.double, 0), jvm.java.util.ArrayList())
    return sum(stages.apply(i).shuffleWriteBytes() for i in range(stages.size()))


def test_lookups_shuffle_a_few_times_the_input(spark):
    """Each slice asks for a bigram once, packed; before, every document's bigrams went through four joins."""
    model = lm.train(spark.read.parquet(LARGER))
    before = shuffled(spark)
    lm.score(spark.read.parquet(LARGER).select("doc_id", "text"), model, broadcast_bytes=0).select("doc_id", "score").write.format("noop").mode("overwrite").save()
    assert shuffled(spark) - before < 12 * os.path.getsize(LARGER)


def test_slices_of_any_size_give_the_same_scores(spark, docs, rows):
    model = lm.train(docs.where("doc_id % 3 <> 0"))
    more = docs.select("doc_id", "text", F.lit("x").alias("slice"), F.lit(1).alias("row"), F.lit(2).alias("id"), F.lit(3).alias("a.b")).repartition(5)
    want = {r.doc_id: r for r in lm.score(docs.select("doc_id", "text"), model).collect()}
    for slice_bytes in (1, 700, 20_000, 1 << 30):
        got = lm.score(more, model, broadcast_bytes=0, slice_bytes=slice_bytes)
        assert got.columns == [*more.columns, "n_tokens", "n_known", "base_score", "score"]
        got = got.collect()
        assert sorted(r.doc_id for r in got) == sorted(i for i, _ in rows) and {r.slice for r in got} == {"x"}
        for r in got:
            x = want[r.doc_id]
            assert (r.text, r.n_tokens, r.n_known) == (x.text, x.n_tokens, x.n_known)
            assert math.isclose(r.base_score, x.base_score, rel_tol=1e-12) and math.isclose(r.score, x.score, rel_tol=1e-12)


def test_runs_of_rows_that_were_read_apart():
    """A slice whose rows are read in two tasks, or with others between, is asked for in parts that begin at their first ids."""
    import pyarrow as pa

    batch = lambda *rows: pa.record_batch([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64()), pa.array([r[2] for r in rows])], names=["slice", "id", "text"])
    got = [(s, i, t.to_pylist()) for s, i, t in lm._runs([batch((1, 4, "a"), (1, 5, "b")), batch((1, 6, None), (2, 7, "d")), batch((2, 9, "e")), batch((1, 10, "f"))])]
    assert got == [(1, 4, ["a", "b", None]), (2, 7, ["d"]), (2, 9, ["e"]), (1, 10, ["f"])]


def test_more_shards_than_blocks(spark):
    """One block, whose bigrams all lie in one of many shards."""
    model = lm.train(spark.read.parquet(f"{SMALL}/documents.parquet"))
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    want = {r.doc_id: r.score for r in lm.score(docs, model).collect()}
    try:
        for n in ("1", "37"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            got = {r.doc_id: r.score for r in lm.score(docs, model, broadcast_bytes=0).collect()}
            assert got.keys() == want.keys() and all(math.isclose(got[i], want[i], rel_tol=1e-12) for i in want)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_tables_go_after_the_last_texts(spark, docs):
    for limit in (1 << 30, 0):
        model = lm.train(docs)
        want = sorted(r.score for r in lm.score(docs.select("text"), model, broadcast_bytes=limit).collect())
        out = lm.score(docs.select("text"), model, broadcast_bytes=limit, last=True)
        assert "bigrams" not in model.staged.paths and sorted(r.score for r in out.collect()) == want
