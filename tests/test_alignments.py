"""Alignments to read rows and junction motifs, against plain Python and fixed cases."""

import random
import re

import pytest
from pyspark.sql import functions as F

from isoloom.functions import chain
from isoloom.operators import alignments as A
from isoloom.operators import chains as C
from isoloom.operators import curate as U
from isoloom.sources import tables

SCHEMA = "read_id string, flag int, Chr string, pos bigint, cigar string, seq string, xs string, ts string, nm int, pt int"


@pytest.mark.parametrize("flag, xs, ts, want", [(0, None, None, "+"), (16, None, None, "-"), (16, "+", "+", "+"), (0, None, "-", "-"), (16, None, "-", "+"), (16, None, "+", "-"), (16, None, ".", "-"), (0, "", None, "+"), (None, None, None, "+")])
def test_strand(spark, flag, xs, ts, want):
    df = spark.createDataFrame([(flag, xs, ts)], "f int, x string, t string")
    assert df.select(A.strand(F.col("f"), F.col("x"), F.col("t"))).first()[0] == want


def walk(pos, cigar, nm, seq):
    """(start, end, chain, identity, coverage) base by base."""
    bases, clip, covered, here = [], 0, 0, pos
    for n, op in re.findall(r"(\d+)([MIDNSHP=X])", cigar):
        n = int(n)
        clip += n if op in "SH" else 0
        covered += n if op in "MI" else 0
        if op not in "ISH":
            if op != "N":
                bases += range(here, here + n)
            here += n
    sites = [x for a, b in zip(bases, bases[1:]) if b != a + 1 for x in (a, b)]
    return bases[0], bases[-1], "-".join(map(str, sites)) or None, 1.0 if nm is None else 1 - nm / covered, (len(seq) - clip) / len(seq)


def test_to_reads(spark):
    rng = random.Random(3)
    rows = []
    for i in range(60):
        ops = "".join(f"{rng.randint(5, 40)}M" + rng.choice(["", "3I4M", "2D6M"]) + f"{rng.randint(60, 90)}N" for _ in range(rng.randint(0, 3)))
        rows.append((f"r{i}", rng.choice([0, 16]), "c1", rng.randint(1, 500), f"{rng.randint(1, 9)}S{ops}20M", "A" * 300, None, None, rng.choice([None, 0, 3]), rng.choice([None, -4, 0, 25])))
    got = {r.read_id: r for r in A.to_reads(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert len(got) == 60
    for read_id, flag, _, pos, cigar, seq, _, _, nm, pt in rows:
        r = got[f"{read_id}.m1"]
        assert (r.TrStart, r.TrEnd, r.SSC) == walk(pos, cigar, nm, seq)[:3]
        assert (r.identity, r.coverage) == pytest.approx(walk(pos, cigar, nm, seq)[3:])
        assert (r.polyA_len, r.has_tail, r.Strand) == (max(0, pt or 0), pt is not None, "-" if flag else "+")


def test_odd_alignments(spark):
    ok = ("a", 0, "c1", 5, "10M", "ACGT", None, None, None, None)
    rows = [ok, ok, ok[:3] + (1,) + ok[4:], ("b", 4) + ok[2:], ("c",) + ok[1:5] + ("*",) + ok[6:], ("d",) + ok[1:4] + ("*",) + ok[5:], ("e",) + ok[1:5] + (None,) + ok[6:]]
    got = A.to_reads(spark.createDataFrame(rows, SCHEMA))
    assert sorted((r.read_id, r.TrStart) for r in got.collect()) == [("a.m1", 1), ("a.m2", 5), ("a.m3", 5)]
    assert not A.has_tails(got).first()[0]
    none = A.to_reads(spark.createDataFrame([], SCHEMA))
    assert none.count() == 0 and A.has_tails(none).first()[0] is False


def test_cigar_of_odd_strings(spark):
    rng = random.Random(8)
    texts = [None, "", "*", "M", "12", "0M", "5M0N3M", "10Q5M", "3S04M2N5", "5MM6N", "N4M", "7N", "2H3S4M1P2=3X4D5I6N7M", "00000000000000000000000012M", "1é2M"]
    texts += ["".join(rng.choice(["7", "12", "300", "M", "N", "S"]) for _ in range(rng.randint(0, 12))) for _ in range(300)]
    got = {r.i: r.x for r in spark.createDataFrame(list(enumerate(texts)), "i int, t string").repartition(3).select("i", chain.cigar(F.col("t")).alias("x")).collect()}
    for i, text in enumerate(texts):
        if text is None:
            assert got[i] is None
            continue
        here = begin = covered = clipped = 0
        exons = []
        for n, op in re.findall(r"([0-9]+)([MIDNSHP=X])", text):
            n = int(n)
            covered, clipped = covered + n * (op in "MI"), clipped + n * (op in "SH")
            if op == "N":
                exons.append((begin, here))
                begin = here + n
            here += n * (op not in "ISH")
        assert got[i] == (exons + [(begin, here)], covered, clipped, here), text
    none = spark.createDataFrame([], "t string").select(chain.cigar(F.col("t")))
    assert none.count() == 0


def test_cigars_are_taken_apart_in_batches(spark):
    """Not by lambdas, which are interpreted, and once for all that is made of a read."""
    reads = A.to_reads(spark.createDataFrame([("a", 0, "c1", 5, "10M20N10M", "A" * 20, None, None, None, None)], SCHEMA))
    plan = reads._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1 and "aggregate(" not in plan


def test_junctions_read_alignments_once(spark):
    bins = U.genome_bins(spark.createDataFrame([("c1", "ACGT" * 20)], "contig string, seq string"))
    reads = A.to_reads(spark.createDataFrame([("a", 0, "c1", 5, "10M20N10M", "A" * 20, None, None, None, None)], SCHEMA))
    out = A.junction_counts(reads, bins)
    assert "cigar" not in out._jdf.queryExecution().optimizedPlan().toString()
    assert [tuple(r) for r in out.collect()] == [(1, "c1", "+", "14-35", "GT-AC")]


def test_junction_counts(spark):
    seq = "".join(random.Random(5).choice("ACGT") for _ in range(400))
    bins = U.genome_bins(spark.createDataFrame([("c1", seq)], "contig string, seq string"), width=7)
    turn = str.maketrans("ACGT", "TGCA")
    rows = [("c1", s, x) for s in "+-" for x in ("20-61-90-131", "6-50", "30-399") for _ in range(2)] + [("c1", "+", None), ("c9", "+", "5-50"), ("c1", "+", "390-900")]
    got = {(r.Chr, r.Strand, r.SSC): (r["count"], r.junction) for r in A.junction_counts(spark.createDataFrame(rows, "Chr string, Strand string, SSC string"), bins, width=7).collect()}
    want = {}
    for c, s, x in rows:
        if x:
            t = list(map(int, x.split("-")))
            here = seq if c == "c1" else ""
            parts = [(here[a : a + 2], here[b - 3 : b - 1]) for a, b in zip(t[::2], t[1::2])]
            if s == "-":
                parts = [(b.translate(turn)[::-1], a.translate(turn)[::-1]) for a, b in parts[::-1]]
            want[c, s, x] = (want.get((c, s, x), (0,))[0] + 1, ",".join("-".join(p) for p in parts))
    assert got == want


def test_sam_to_chains(spark, tmp_path):
    lines = ["@HD\tVN:1.6"] + [f"r{i}\t{f}\tc1\t101\t60\t50M100N50M\t*\t0\t0\t{'A' * 100}\t*\tNM:i:1\tpt:i:30" for i, f in enumerate([0, 0, 16, 4])]
    (tmp_path / "s1.sam").write_text("\n".join(lines) + "\n")
    reads = A.to_reads(tables.read_sam(spark, str(tmp_path)))
    got = C.collapse(C.good_reads(reads)).collect()
    assert sorted((r.Strand, r.SSC, r.frequency, r.lo, r.hi) for r in got) == [("+", "150-251", 2, 101, 300), ("-", "150-251", 1, 101, 300)]
