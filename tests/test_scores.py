"""Score tables by file name, reading frames in nested files, and their joins."""

import random

from pyspark.sql import functions as F

from isoloom.operators import scores as X
from isoloom.sources import scores as S

ENDS = "Chr string, Strand string, SSC string, TrStart long, TrEnd long"


def profile(peaks, n=400):
    """Text of a file's row: small everywhere but at offsets."""
    values = [0.001] * n
    for at, height in peaks.items():
        values[at - S.FIRST_OFFSET] = height
    return f"{S.TRACK}," + ",".join(map(str, values))


def test_tss_scores(spark, tmp_path):
    write = lambda name, *lines: (tmp_path / name).write_text("\n".join(["," + ",".join(map(str, range(400))), *lines]) + "\n")
    write("scorer_chr1_100_201_plus.csv", "other row,1,2,3", profile({-20: 0.9, 3: 0.5, 60: 5}))
    write("scorer_chr1_100_201_minus.csv", profile({}))
    write("scorer_chrUn_7_3_4_plus.csv", profile({-15: 0.2, 15: 0.2}))
    write("scorer_chr2_5_6_plus.csv", "other row,1,2,3")
    write("scorer_chr2_5_7_plus.csv", f"{S.TRACK},0.5,0.5")
    write("notes_chr2_x_7_plus.csv", profile({0: 1}))
    write("scorer_chr3_8_8_plus.csv", profile({0: 1}).replace("0.001", "nan?", 1).replace("0.001", "-", 1))
    (tmp_path / "scorer_chr1_1_1_plus.txt").write_text(profile({0: 1}))
    got = {(r.Chr, r.Strand, r.query_tss): (tuple(r.tss_15 or ()), tuple(r.tss_50 or ())) for r in S.read_tss_scores(spark, str(tmp_path)).collect()}
    assert got == {("chr1", "+", 150): ((3, 0.5), (-20, 0.9)), ("chr1", "-", 150): ((), ()), ("chrUn_7", "+", 3): ((-15, 0.2), (-15, 0.2)), ("chr3", "+", 8): ((0, 1.0), (0, 1.0))}


def test_starts_meet_scores(spark):
    t = spark.createDataFrame([("c", "+", "5-9", 1, 20), ("c", "-", "5-9", 1, 20), ("c", "+", "6-9", 2, 20), ("d", "+", None, 1, 2)], ENDS)
    peak = lambda h: (0, h)
    s = spark.createDataFrame([("c", "+", 1, peak(0.5), peak(0.6)), ("c", "-", 20, peak(0.7), None), ("c", "-", 1, peak(0.8), None), ("e", "+", 1, peak(0.9), None)], "Chr string, Strand string, query_tss long, tss_15 struct<offset:int,height:double>, tss_50 struct<offset:int,height:double>")
    got = sorted(((r.Chr, r.Strand, r.SSC, r.TrStart, r.tss_15 and r.tss_15.height) for r in X.with_tss_scores(t, s).collect()), key=str)
    assert got == sorted([("c", "+", "5-9", 1, 0.5), ("c", "-", "5-9", 1, 0.7), ("c", "+", "6-9", 2, None), ("d", "+", None, 1, None), ("c", "-", None, None, 0.8)], key=str)
    assert X.with_tss_scores(t.limit(0), s).count() == 0 and X.with_tss_scores(t, s.limit(0)).count() == 4


def test_shift_and_sum(spark):
    rows = [("c", "+", "5-9", 10, 50, 3, 2, 0.5, "b"), ("c", "+", "5-9", 11, 50, 4, 1, 0.5, "a"), ("c", "+", "5-9", 11, 50, 5, 9, 0.01, None), ("c", "-", "5-9", 11, 50, 6, 3, 0.5, "m"), ("c", "-", "5-9", 11, 48, 7, None, None, "n"), ("c", "+", None, 11, 48, 7, None, None, "n")]
    df = spark.createDataFrame(rows, ENDS + ", frequency long, tss_offset int, tss_height double, name string").withColumn("first", F.lit(1)).withColumn("s", F.lit(2))
    got = sorted((r.Strand, r.TrStart, r.TrEnd, r.frequency, r.name) for r in X.shift_and_sum(df).collect())
    assert got == [("+", 11, 50, 12, "b"), ("-", 11, 48, 13, "n")]
    assert [r.name for r in X.shift_and_sum(df.where("Strand = '+'"), first_by=["frequency"]).collect()] == ["b"]
    assert [r.name for r in X.shift_and_sum(df.where("Strand = '+'"), first_by=["name"]).collect()] == [None]
    out = X.shift_and_sum(df.limit(0))
    assert out.count() == 0 and out.columns == df.columns


def test_frames(spark, tmp_path):
    deep = tmp_path / "chr1_+" / "more"
    deep.mkdir(parents=True)
    head = ">chr1:1-99(+)(10~20-30~40)"
    good = [f"{head}\t1,16,0.9,0.95", f"{head}\t4,19,0.97,0.91,7,8,0.1,0.1", f"  {head}\t7,22,0.97,0.92  ", ">chr2:5(-)(1~2-3~4)\t0,9,0.5,0.5"]
    bad = ["", "   ", head, f"{head}\t1,2,0.5", f"{head}\tx,2,0.5,0.5", f"{head}\t1.5,2,0.5,0.5", ">chr1:1(+)\t1,2,0.5,0.5", ">chr1:1(+)(1~2-3)\t1,2,0.5,0.5", ">chr1:1(+)(a~2-3~9)\t1,2,0.5,0.5", f"{head}1,16,0.9,0.95"]
    (deep / "a_predORFs_0.5_0.5.txt").write_text("\n".join(good[:2] + bad) + "\n")
    (tmp_path / "b_predORFs_0.5_0.5.txt").write_text("\r\n".join(good[2:]))
    (tmp_path / "c_predORFs_0.5_0.5.txt").write_text("")
    (tmp_path / "c_predORFs_0.1_0.1.txt").write_text(good[0])
    got = S.read_frames(spark, str(tmp_path))
    assert sorted(map(tuple, got.collect())) == [("chr1", "+", 10, 40, "20-30", 1, 16, 0.9, 0.95), ("chr1", "+", 10, 40, "20-30", 4, 19, 0.97, 0.91), ("chr1", "+", 10, 40, "20-30", 7, 22, 0.97, 0.92), ("chr2", "-", 1, 4, "2-3", 0, 9, 0.5, 0.5)]
    t = spark.createDataFrame([("chr1", "+", "20-30", 10, 40), ("chr2", "-", "2-3", 1, 4), ("chr3", "+", "2-3", 1, 4)], ENDS)
    out = X.spelled(X.with_frames(t.withColumn("TIS_score", F.lit("no")), got))
    assert sorted((r.Chr, r.TIS_related_location, r.TTS_related_location, r.TIS_score, r.Predict_NMD) for r in out.collect()) == [("chr1", "7", "22", "0.97", "Normal"), ("chr2", "0", "9", "0.5", "no_orf"), ("chr3", "no", "no", "no", "no_orf")]
    assert X.with_frames(t, got.limit(0)).where("Predict_NMD = 'no_orf'").count() == 3
    assert X.with_frames(t.limit(0), got).count() == 0


def test_best_frames_of_ties(spark):
    rng = random.Random(5)
    rows = [("c", "+", "2-3", 1, 9, rng.randint(0, 3), rng.randint(4, 6), rng.choice([0.5, 0.9]), rng.choice([0.5, 0.9])) for _ in range(50)]
    df = spark.createDataFrame(rows, ENDS + ", TIS_related_location long, TTS_related_location long, TIS_score double, TTS_score double")
    want = min((-p, -q, a, b) for *_, a, b, p, q in rows)
    for k in (1, 4):
        r = X.best_frames(df.repartition(k)).collect()
        assert [(-x.TIS_score, -x.TTS_score, x.TIS_related_location, x.TTS_related_location) for x in r] == [want]
