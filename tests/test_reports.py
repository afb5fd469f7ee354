"""Guards, assessment tables, matrices of the model, and files of samples."""

import json

import pytest
from pyspark.sql import functions as F

from isoloom.operators import guards
from isoloom.operators import reports as P


def test_guard_counts_while_it_writes(spark, tmp_path):
    df = spark.range(100).repartition(3)
    guard = guards.Guard(spark, str(tmp_path / "log"))
    kept = guard.run("1.4", df, lambda x: x.where("id >= 20"), {"run": "a"})
    assert kept.count() == 80 and "parquet" in kept._jdf.queryExecution().toString().lower()
    less = guard.run("other", kept, lambda x: x.where("id < 22"))
    assert sorted(r.id for r in less.collect()) == [20, 21]
    records = sorted((json.loads(x) for p in (tmp_path / "log").glob("*.json") for x in p.read_text().splitlines()), key=lambda r: r["stage"])
    assert [(r["stage"], r["input"], r["output"], r["drop_rate"], r["level"]) for r in records] == [("1.4", 100, 80, 20.0, "WARNING"), ("other", 80, 2, 97.5, "FAIL")]
    assert json.loads(records[0]["metadata"]) == {"run": "a"} and "metadata" not in records[1]


def test_guard_stops(spark, tmp_path):
    df = spark.range(10)
    strict = guards.Guard(spark, str(tmp_path / "log"), strict=True)
    with pytest.raises(guards.StageError, match="1.5"):
        strict.run("1.5", df, lambda x: x.where("id < 3"))  # exactly the fail limit
    assert strict.run("1.5", df, lambda x: x.where("id < 4")).count() == 4
    with pytest.raises(guards.StageError, match="none"):
        guards.Guard(spark).run("1.2", df, lambda x: x.where("id < 0"))
    assert guards.Guard(spark, allow_zero=True).run("1.2", df, lambda x: x.where("id < 0")).count() == 0
    # nothing in, nothing out: no boundary to speak of
    assert strict.run("1.2", df.limit(0), lambda x: x).count() == 0
    assert sum(1 for p in (tmp_path / "log").glob("*.json") for _ in p.read_text().splitlines()) == 2


def test_require_frames(spark):
    none = spark.range(60).select(F.lit(None).cast("long").alias("TIS_related_location"))
    with pytest.raises(guards.StageError, match="60"):
        guards.require_frames(none)
    guards.require_frames(none, 0)
    guards.require_frames(none, 60)
    guards.require_frames(none.unionByName(spark.range(1).select(F.col("id").alias("TIS_related_location"))))


def test_assessment(spark):
    base = spark.createDataFrame([(i, i % 3) for i in range(9)], "n int, k int")
    wide = base.select(*[F.col("k").alias(c) if c in ("Chr", "Strand", "TrStart", "TrEnd", "SSC") else F.col("n").alias(c) for c in P.CORE], F.lit(1).alias("polyA_count"), F.lit(2).alias("polyA_median"), F.lit(3).alias("other"), F.lit(4).alias("row"))
    out = P.assessment(wide)
    assert out.columns == [*P.CORE, "polyA_median", "polyA_count"]
    assert sorted((r.Chr, r.frequency) for r in out.collect()) == [(0, 0), (1, 1), (2, 2)]
    for gone in ("Chr", "seq_len"):
        with pytest.raises(P.SchemaError, match=gone):
            P.assessment(wide.drop(gone))
    assert P.required(wide, P.CORE) == list(P.CORE) and P.assessment(wide.limit(0)).count() == 0


def test_matrices_of_model(spark):
    keys = "TrID string, GeneID string, GeneName string"
    model = spark.createDataFrame([("a", "g", "G", 1), ("b", "g", "G", 2), ("c", "h", "H", 3), ("c", "h", "H", 4), ("d", "h", "H", 5)], keys + ", n int")
    counts = spark.createDataFrame([("a", "g", "G", 0, 2.0), ("b", "g", "G", 0, 0.0), ("c", "h", "H", None, 1.0), ("x", "h", "H", 9, 9.0)], keys + ", `s.1` long, s2 double")
    cpm = spark.createDataFrame([("a", "g", "G", 7, "kept"), ("b", "g", "G", 8, "gone")], keys + ", `s.1` int, note string")
    genes = spark.createDataFrame([("g", 3)], "GeneID string, s long")
    m, out = P.matrices_of_model(model, {"transcript.counts": counts, "transcript.cpm": cpm, "gene.counts": genes})
    assert sorted((r.TrID, r.n) for r in m.collect()) == [("a", 1), ("c", 3), ("c", 4)]
    rows = lambda k: sorted(map(tuple, out[k].collect()))
    assert rows("transcript.counts") == [("a", "g", "G", 0, 2), ("c", "h", "H", 0, 1)]
    assert rows("transcript.cpm") == [("a", "g", "G", 7.0, "kept"), ("c", "h", "H", 0.0, None)] and rows("gene.counts") == [("g", 3)]
    assert dict(out["transcript.cpm"].dtypes)["s.1"] == "double" and dict(out["transcript.counts"].dtypes)["s2"] == "bigint"
    everything, _ = P.matrices_of_model(model, {"transcript.cpm": cpm})
    assert everything.count() == 5
    _, none = P.matrices_of_model(model.limit(0), {"transcript.counts": counts})
    assert none["transcript.counts"].count() == 0


def test_files_of_samples(spark, tmp_path):
    path = str(tmp_path / "reads")
    row = lambda i, s: (f"r{i}", "c1", "+", 10 * (i % 7), 99 + i, None if i % 4 == 0 else "20-30", 0.99, 1.0, i, s)
    schema = P.tables.READS + ", sample string"
    rows = [row(i, f"s{i % 3}") for i in range(60)]
    df = spark.createDataFrame(rows, schema).repartition(4)
    P.write_reads(df.withColumn("extra", F.lit(1)), path)
    back = P.read_samples(spark, path)
    assert sorted(map(tuple, back.select(df.columns).collect()), key=str) == sorted(rows, key=str)
    for f in (tmp_path / "reads").glob("sample=*/part-*.csv"):
        at = [int(line.split("\t")[3]) for line in f.read_text().splitlines()]
        assert at == sorted(at)
    # one sample again: the others stay as they are
    others = {f: f.read_text() for f in (tmp_path / "reads").glob("sample=s[02]/part-*.csv")}
    P.write_reads(spark.createDataFrame([row(100, "s1")], schema), path)
    assert {f: f.read_text() for f in (tmp_path / "reads").glob("sample=s[02]/part-*.csv")} == others
    assert [r.read_id for r in P.read_samples(spark, path).where("sample = 's1'").collect()] == ["r100"]
    counts = spark.createDataFrame([(3, "c", "+", "2-5", "GT-AG", "s0")], P.tables.JUNCTIONS + ", sample string")
    P.write_junctions(counts, str(tmp_path / "j"))
    assert [tuple(r) for r in P.read_samples(spark, str(tmp_path / "j"), P.tables.JUNCTIONS).collect()] == [(3, "c", "+", "2-5", "GT-AG", "s0")]


def test_write_table(spark, tmp_path):
    P.write_table(spark.createDataFrame([(2, None), (1, "x")], "a int, b string").repartition(2), str(tmp_path / "t"), ["a"])
    lines = [line for f in sorted((tmp_path / "t").glob("part-*.csv")) for line in f.read_text().splitlines()]
    assert [x for x in lines if x != "a\tb"] == ["1\tx", "2\t"] and "a\tb" in lines


def test_polya_profiles(spark, tmp_path):
    import random
    import statistics

    from isoloom.operators import termini as T

    rng = random.Random(1)
    rows = [(k, rng.choice([0, 3, 4, 9, 50])) for k in "aab" for _ in range(41)] + [("b", 7), ("c", 0), ("d", None), ("e", 5)]
    df = spark.createDataFrame(rows, "k string, polyA_len int")
    tails = {}
    for k, n in rows:
        if n:
            tails.setdefault(k, []).append(n)
    want = {k: (round(statistics.median(v), 1), round(sum(v) / len(v) + 1e-9, 1), len(v), sorted(v)) for k, v in tails.items()}
    P.write_polya(T.polya_profiles(df, ["k"]), str(tmp_path / "short"))
    P.write_polya(T.polya_profiles(df.groupBy("k", "polyA_len").count(), ["k"], "count"), str(tmp_path / "raw"), raw=True)
    short = {r.k: (r.polyA_median, r.polyA_mean, r.polyA_count, [x.length for x in r.lengths for _ in range(x.n)]) for r in spark.read.parquet(str(tmp_path / "short")).collect()}
    raw = {r.k: (r.polyA_median, r.polyA_mean, r.polyA_count, [int(x) for x in r.raw_polyA_lengths]) for r in spark.read.parquet(str(tmp_path / "raw")).collect()}
    assert short == want and raw == want
    assert {tuple(r) for r in T.polya_lengths(df, ["k"]).collect()} == {(k, *v[:3]) for k, v in want.items()}
