"""Operators without SQL, and single functions, against plain Python or fixed cases."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from isoloom.functions import chain
from isoloom.operators import chains as C
from isoloom.operators import curate as U
from isoloom.operators import quantify as Q
from isoloom.operators import remap as R
from isoloom.operators import termini as T
from isoloom.sources import tables


def one(spark, column, **values):
    return spark.createDataFrame([tuple(values.values())], list(values)).select(column).first()[0]


@pytest.mark.parametrize("text, want", [("NA", []), ("", []), ("abc", []), ("none", []), ("100-200-300", [100, 200, 300])])
def test_sites(spark, text, want):
    assert one(spark, chain.sites(F.col("x")), x=text) == want


@pytest.mark.parametrize("part, want", [("1-2", True), ("3-4", True), ("1-2-3-4-5-6", False), ("1-2-3-4-5-6-7-8", False), ("2-1", False), ("1-2-5-6", False), ("", False)])
def test_sub_chain(spark, part, want):
    assert one(spark, chain.is_sub_chain(chain.sites(F.col("p")), chain.sites(F.col("t"))), p=part, t="1-2-3-4-5-6") is want


def test_reverse_complement(spark):
    assert one(spark, chain.reverse_complement(F.col("x")), x="ACGTNRYSWKMBDHV") == "BDHVKMWSRYNACGT"
    assert one(spark, chain.reverse_complement(F.col("x")), x="ACGT-N") == "N-ACGT"
    assert one(spark, chain.reverse_complement(F.col("x"), plain=True), x="anN") == "NNT"


@pytest.mark.parametrize("window, want", [("AAAAAAAAAAGGGGGGGGGG", True), ("GCGCGCGCGCGCGCGCGCGC", False), ("GCGC", True)])
def test_primed(spark, window, want):
    assert one(spark, chain.primed_inside(F.col("x")), x=window) is want


def test_golden_coordinates(spark):
    ex = chain.exons(F.lit(1000), chain.sites(F.lit("2000-3000")), F.lit(4000))
    cut = lambda a, b: [tuple(r) for r in one(spark, chain.segments(ex, F.lit("+"), F.lit(a), F.lit(b)), x=1)]
    assert cut(11, 1499) == [(1010, 2000), (3000, 3497)]
    assert cut(1, 10) == [(1000, 1009)] and cut(1500, 2002) == [(3498, 4000)]
    assert [tuple(r) for r in one(spark, chain.exons(F.lit(5000), chain.sites(F.lit("5500")), F.lit(6000)), x=1)] == [(5000, 6000)]


def test_segments_walk_both_strands(spark):
    rng = random.Random(4)
    rows = []
    for i in range(40):
        at = sorted(rng.sample(range(1, 400), 2 * rng.randint(1, 4)))
        bases = [b for s, e in zip(at[::2], at[1::2]) for b in range(s, e + 1)]
        strand = rng.choice("+-")
        walk = bases if strand == "+" else bases[::-1]
        lo = rng.randint(1, len(walk))
        hi = rng.randint(lo, len(walk))
        rows.append((i, strand, [{"s": s, "e": e} for s, e in zip(at[::2], at[1::2])], lo, hi, sorted(walk[lo - 1 : hi])))
    df = spark.createDataFrame(rows, "i int, strand string, x array<struct<s:bigint,e:bigint>>, lo bigint, hi bigint, want array<bigint>")
    for r in df.select("want", chain.segments(F.col("x"), F.col("strand"), F.col("lo"), F.col("hi")).alias("got")).collect():
        assert [b for g in r.got for b in range(g.s, g.e + 1)] == r.want


def weak_edges(rows, weight, safe):
    rows = dict(rows)
    while True:
        total = sum(rows.values())
        w, deg = Counter(), Counter()
        for c, f in rows.items():
            for e in zip(c, c[1:]):
                w[e] += f / total
        for u, v in w:
            deg[u] += 1
            deg[v] += 1
        bad = {e for e, x in w.items() if x < weight and (deg[e[0]] == 1 or deg[e[1]] == 1)}
        left = {c: f for c, f in rows.items() if f >= safe or not bad & set(zip(c, c[1:]))}
        if len(left) == len(rows):
            return set(left)
        rows = left


def test_weak_edges(spark, tmp_path):
    spark.sparkContext.setCheckpointDir(str(tmp_path))
    rng = random.Random(9)
    rows = {tuple(sorted(rng.sample(range(10, 200), rng.choice((2, 4, 6))))): rng.randint(1, 9) for _ in range(40)}
    df = spark.createDataFrame([("c", "+", "-".join(map(str, c)), f, 0) for c, f in rows.items()], "Chr string, Strand string, SSC string, frequency long, Group long")
    got = {tuple(map(int, r.SSC.split("-"))) for r in C.drop_weak_edges(df, 0.05, 5).collect()}
    assert got == weak_edges(rows, 0.05, 5) and len(got) < len(rows)


def terminal_pairs(reads):
    """Of one chain, by brute force."""
    def modes(values, last):
        n = Counter(values)
        core = sorted(v for v in n if sum(k for x, k in n.items() if abs(x - v) <= 15) >= max(len(values) // 10, 20))
        groups = []
        for v in core:
            if groups and v - groups[-1][-1] <= 15:
                groups[-1].append(v)
            else:
                groups.append([v])
        own = {}
        for v in n:
            near = [(abs(c - v), c) for c in core if abs(c - v) <= 15]
            if near:
                own[v] = next(i for i, g in enumerate(groups) if min(near)[1] in g)
        out = []
        for i in range(len(groups)):
            m = {v: k for v, k in n.items() if own.get(v) == i}
            out.append(min(m, key=lambda v: (-m[v], -v if last else v)))
        return out

    s, e = modes([a for a, _ in reads], False), modes([b for _, b in reads], True)
    raw = Counter(reads)
    if not s or not e:
        return {(min(a for a, _ in reads), max(b for _, b in reads)): len(reads)}
    seen = [(a, b) for a in s for b in e if (a, b) in raw]
    if not seen:
        return {(min(s), max(e)): len(reads)}
    near = Counter(min(seen, key=lambda c: ((c[0] - a) ** 2 + (c[1] - b) ** 2, c)) for a, b in raw)
    return {c: round(len(reads) * n / len(raw)) for c, n in near.items()}


def test_terminal_pairs(spark):
    rng = random.Random(2)
    groups = {}
    for g in range(12):
        centres = [(rng.randint(0, 300), rng.randint(1000, 1300)) for _ in range(rng.randint(1, 3))]
        groups[str(g)] = [(a + rng.randint(-6, 6), b + rng.randint(-6, 6)) for a, b in (rng.choice(centres) for _ in range(rng.choice((5, 60, 150))))]
    df = spark.createDataFrame([("c", "+", g, a, b) for g, x in groups.items() for a, b in x], "Chr string, Strand string, SSC string, TrStart long, TrEnd long")
    got = {}
    for r in T.terminal_pairs(df).collect():
        got.setdefault(r.SSC, {})[r.TrStart, r.TrEnd] = r.frequency
    assert got == {g: terminal_pairs(x) for g, x in groups.items()}


READ = "sample string, Chr string, Strand string, SSC string, TrStart long, TrEnd long, polyA_len int"
TR = "Chr string, Strand string, SSC string, TrStart long, TrEnd long, TrID string, GeneID string"


def test_counts_need_ids(spark):
    bad = spark.createDataFrame([("c", "+", "1-2", 1, 9, "t", None)], TR)
    reads = spark.createDataFrame([("s", "c", "+", "1-2", 1, 9, 0)], READ)
    with pytest.raises(Exception, match="no TrID or GeneID"):
        Q.transcript_counts(reads, bad).collect()


def test_counts_of_two_transcripts_of_one_chain(spark):
    t = spark.createDataFrame([("c", "+", "10-20", 10, 50, "T1", "G"), ("c", "+", "10-20", 400, 900, "T2", "G"), ("c", "+", "10-20", 400, 900, "T2", "G"), ("c", "-", "10-20", 10, 50, "T3", "H")], TR)
    reads = [("s", "c", "+", "10-20", 12, 48, 30)] * 2 + [("s", "c", "+", "13-24", 10, 50, 0)] + [("s", "c", "+", "10-20", 430, 930, 0)] * 5 + [("s", "c", "+", "10-20", 200, 300, 9), ("s", "c", "+", None, 10, 50, 9), ("s", "c", "+", "70-90", 10, 50, 9)]
    fixed = T.correct_reads(spark.createDataFrame(reads, READ), t)
    assert fixed.columns == [c.split()[0] for c in READ.split(", ")]
    got = sorted((r.SSC, r.TrStart, r.TrEnd) for r in fixed.collect())
    assert got == [("10-20", 10, 50)] * 3 + [("10-20", 200, 300)] + [("10-20", 400, 900)] * 5 + [("70-90", 10, 50)]
    assert sorted((r.TrID, r["count"]) for r in Q.transcript_counts(fixed, t).collect()) == [("T1", 3), ("T2", 5)]
    tails = {(r.TrID, r.polyA_valid_reads, r.polyA_frac) for r in T.polya_fraction(fixed, t).collect()}
    assert tails == {("T1", 2, 2 / 3), ("T2", 0, 0.0), ("T3", 0, None)}
    none = spark.createDataFrame([], READ)
    assert T.correct_reads(none, t).count() == 0 and Q.transcript_counts(none, t).count() == 0
    assert T.correct_reads(fixed, t.limit(0)).count() == 10 and Q.cpm(Q.transcript_counts(fixed, t.limit(0))).count() == 0


def test_fragments_are_judged_by_mean_ends_and_case(spark):
    rows = [("a", "1000-1200", 1, "GT-AG", 850.0, 1400.0), ("b", "1000-1200", 1, "GT-AG", 950.0, 1400.0), ("c", "1000-1200", 1, "gt-ag", 850.0, 1400.0), ("d", "1000-1200-1300-1400", 1, "GT-AG,GC-AG", 950.0, 1420.0), ("e", "1000-1200", 1, None, None, None), ("f", "1000-1200", 900, "no", 999.0, 1201.0)]
    df = spark.createDataFrame([("x", "+", *r) for r in rows], "Chr string, Strand string, id string, SSC string, frequency long, junction string, mean_start double, mean_end double")
    assert {r.id for r in C.drop_fragments(df).collect()} == {"a", "d", "e", "f"}


def test_downsample(spark):
    df = spark.createDataFrame([(f"t{i}", f"g{i % 3}") for i in range(30)], "TrID string, GeneID string")
    left = Q.downsample(df, 0.4)
    assert {r["count"] for r in left.groupBy("GeneID").count().collect()} == {6}
    assert sorted(left.collect()) == sorted(Q.downsample(df.repartition(5), 0.4).collect())


def test_files(spark, tmp_path):
    (tmp_path / "a_flnc.ssc").write_text("r1\tchr1\t+\t1\t9\t3-5\t0.99\t1.0\t20\nr2\tchr1\t+\t1\t9\tNA\t0.9\t1.0\t0\n")
    got = tables.read_reads(spark, str(tmp_path / "a_flnc.ssc")).orderBy("read_id").collect()
    assert [(r.SSC, r["sample"]) for r in got] == [("3-5", "a"), (None, "a")]
    (tmp_path / "x.fa").write_text(">c1 first\nACGT\nAC\n>c2\nGG\n")
    assert {r.contig: r.seq for r in tables.read_fasta(spark, str(tmp_path / "x.fa")).collect()} == {"c1": "ACGTAC", "c2": "GG"}
    (tmp_path / "x.sam").write_text("@HD\tVN:1\nr1\t0\tc1\t5\t60\t4M\t*\t0\t0\tACGT\t*\tNM:i:1\tXS:A:-\nr2\t4\t*\t0\t0\t*\t*\t0\t0\tAC\t*\n")
    got = tables.read_sam(spark, str(tmp_path / "x.sam")).collect()
    assert [(r.read_id, r.pos, r.nm, r.xs, r.pt) for r in got] == [("r1", 5, 1, "-", None)]


def test_consensus_sites(spark):
    rng = random.Random(5)
    names = set()
    while len(names) < 60:
        names.add("-".join(map(str, sorted(rng.sample(range(100, 400), rng.choice([2, 4]))))))
    rows = [("c", "+", g, n, rng.choice([1, 1, 2, 5, 40, 200])) for g in (0, 1) for n in sorted(names)]
    df = spark.createDataFrame(rows, "Chr string, Strand string, Group bigint, SSC string, frequency bigint")
    bad = set()
    for g in (0, 1):
        clusters: dict[int, list] = {}
        mine = sorted((r for r in rows if r[2] == g), key=lambda r: (-r[4], -len(r[3].split("-")), r[3]))
        for r in mine:
            for s in map(int, r[3].split("-")):
                clusters.setdefault(next((c for c in clusters if abs(c - s) <= 20), s), []).append((s, r[4]))
        for found in clusters.values():
            reads = Counter()
            for s, f in found:
                reads[s] += f
            if len(found) != sum(reads.values()):
                bad |= {(g, s) for s, f in reads.items() if f / max(reads.values()) < 0.1}
    assert bad
    assert {(r.Group, r.site) for r in U.off_consensus(df).collect()} == bad


def test_sequences_over_bins(spark):
    contigs = spark.createDataFrame([("c", "ACGTACGGTTCAGATTACAG")], "contig string, seq string")
    t = spark.createDataFrame([("a", "c", "+", 2, 18, "9-13"), ("b", "c", "-", 2, 18, "9-13"), ("x", "none", "+", 1, 5, None)], "TrID string, Chr string, Strand string, TrStart bigint, TrEnd bigint, SSC string")
    got = {r.TrID: (r.seq, r.seq_len) for r in U.transcript_sequences(t, U.genome_bins(contigs, 7), 7).collect()}
    assert got == {"a": ("CGTACGGTGATTAC", 14), "b": ("GTAATCACCGTACG", 14)}
    lines = [r.value for r in U.fasta_records(spark.createDataFrame([("a", "ACGTA"), ("b", "ACGT")], "TrID string, seq string"), 2).collect()]
    assert lines == [">a\nAC\nGT\nA", ">b\nAC\nGT"]


def test_primed_inside_counts_letters_once(spark):
    assert one(spark, chain.primed_inside(F.col("x")), x="CGCGCGCGß") is True  # nine letters


def test_sequences_beyond_a_contig(spark):
    contigs = spark.createDataFrame([("c", "ACGTACGGTTCAGATTACAG"), ("empty", "")], "contig string, seq string")
    rows = [("part", "c", "+", 2, 200, "9-13"), ("edge", "c", "-", 18, 40, "24-30"), ("past", "c", "-", 21, 60, "30-40"), ("far", "c", "+", 900, 990, None), ("x", "none", "+", 1, 5, None), ("y", "empty", "+", 1, 5, None)]
    t = spark.createDataFrame(rows, "TrID string, Chr string, Strand string, TrStart bigint, TrEnd bigint, SSC string")
    got = {r.TrID: (r.seq, r.seq_len) for r in U.transcript_sequences(t, U.genome_bins(contigs, 7), 7).collect()}
    assert got == {"part": ("CGTACGGTGATTACAG", 16), "edge": ("CTG", 3), "past": ("", 0), "far": ("", 0)}


def test_best_scored(spark):
    df = spark.createDataFrame([([(1, 0.2), (5, 0.9), (7, 0.9)],), ([],)], "x array<struct<at: bigint, score: double>>")
    at = lambda k: [[s.at for s in r[0]] for r in df.select(chain.best_scored(F.col("x"), k)).collect()]
    assert at(2) == [[7, 5], []]
    assert at(0.2) == [[7, 5, 1], []]
    assert at(0.95) == [[], []]


@pytest.mark.parametrize("strand, sites, category, reads, want", [
    ("+", "100-200-300-900", "NIC", 5, "100-200-300-320-340-900"),  # a little exon jumped
    ("+", "100-200-305-900", "NNC", 5, "100-200-300-320-340-900"),  # with a displaced site
    ("+", "100-200-305-890", "NNC", 5, "100-200-300-320-340-900"),  # with two
    ("+", "100-200-290-900", "NNC", 5, "100-200-290-900"),  # outside the path
])
def test_map_little_exons(spark, strand, sites, category, reads, want):
    ref = spark.createDataFrame([("c", strand, 1, "100-200-300-320-340-900")], "Chr string, Strand string, Group long, SSC string")
    c = spark.createDataFrame([("c", strand, 1, sites, reads, category, 0.0, 1000.0), ("c", strand, 1, "100-200", 100, "FSM", 0.0, 1000.0)], "Chr string, Strand string, Group long, SSC string, frequency long, category string, mean_start double, mean_end double")
    got = {r["SSC"]: r["mapped_SSC"] for r in R.map_to_reference(c, ref).collect()}
    assert got == {sites: want, "100-200": "100-200"}


@pytest.mark.parametrize("strand, sites, reads, want", [
    ("+", "100-210-300-500", 5, "100-200-300-500"),  # one site, rare
    ("+", "100-210-300-500", 95, "100-210-300-500"),  # not rare
    ("+", "100-225-300-500", 5, "100-225-300-500"),  # too far
    ("+", "100-205-312-500", 95, "100-200-300-500"),  # two, the same way
    ("+", "100-195-312-500", 5, "100-195-312-500"),  # two, opposite ways
    ("+", "100-200-300-490-510-530", 5, "100-200-300-500"),  # a tail on one site
    ("-", "70-80-90-200-300-500", 5, "100-200-300-500"),
    ("-", "100-200-300-490-510-530", 5, "100-200-300-490-510-530"),  # at the wrong end
])
def test_pull_sites(spark, strand, sites, reads, want):
    ref = spark.createDataFrame([("c", strand, 1, "100-200-300-500")], "Chr string, Strand string, Group long, SSC string")
    ends = (60.0, 540.0)
    c = spark.createDataFrame([("c", strand, 1, sites, reads, "NNC", *ends), ("c", strand, 1, "100-200-300-500", 50, "FSM", *ends)], "Chr string, Strand string, Group long, SSC string, frequency long, category string, mean_start double, mean_end double")
    got = {r["SSC"]: r["mapped_SSC"] for r in R.map_to_reference(c, ref).collect()}
    assert got[sites] == want


def test_remap_ids(spark):
    schema = "TrID string, GeneID string, GeneName string, Chr string, Strand string, SSC string"

    def run(novel, n, tail=""):
        ref = [(f"T{i}", "ENSG%011d.1" % i, f"GENE{i}", "chr1", "+", "100-200") for i in range(n)]
        rows = [(t, "NovelGene7", "NovelGene7", "chr1", "+", "100-200") for t in novel]
        out = R.remap_novel_genes(spark.createDataFrame(rows, schema), spark.createDataFrame(ref, schema)).collect()
        return {r["TrID"] for r in out}, {r["GeneID"] for r in out}

    tx, genes = run(["NovelGene7_NovelTr0", "NovelGene7_NovelTr1"], 25)
    assert genes == {"NovelGeneCluster_LongFusion_1"} and len(tx) == 2
    assert run(["NovelGene7_NovelTr0"], 2)[1] == {"NovelGeneCluster_ENSG00000000000.1_ENSG00000000001.1"}
    assert run(["A_x", "B_x"], 1)[0] == {"ENSG00000000000.1_A_x", "ENSG00000000000.1_B_x"}
    assert run(["NovelGene7_" + "t" * 80], 9)[1] == {"NovelGeneCluster_LongFusion_1"}
    assert run(["NovelGene7_x"], 0)[0] == {"NovelGene7_x"}


def test_fork_pairs(spark):
    c = spark.createDataFrame([("c", "+", 1, "100-200-250-300", 100, True), ("c", "+", 1, "100-300", 4, False), ("c", "+", 1, "90-310", 50, False)], "Chr string, Strand string, Group long, SSC string, frequency long, known boolean")
    pairs = C.fork_pairs(c)
    got = {(*r["p4"][1:3], r["f4"], r["f6"], r["n4"], r["n6"]) for r in pairs.collect()}
    assert got == {(100, 300, 4, 100, 220, 270), (90, 310, 50, 100, 200, 270)}
    assert {tuple(r["fragment"]) for r in C.exon_jump_errors(pairs, 60, 0.05).collect()} == {(100, 300)}
    assert {tuple(r["fragment"]) for r in C.fake_exon_errors(pairs, 60, 0.2).collect()} == {(100, 300)}
    assert C.exon_jump_errors(pairs, 40, 0.05).count() == 0


def test_truncation_spares_independent_starts(spark):
    rows = [("100-200-300-400", 100, None), ("300-400", 5, "0.1"), ("100-200", 5, "0.09"), ("200-300-300-400", 1, "NaN"), ("100-200-300-400-500-600", 300, "no")]
    df = spark.createDataFrame([("chr1", "+", 0, *r) for r in rows], "Chr string, Strand string, Group long, SSC string, frequency long, tss string")
    run = lambda **k: {r.SSC: r.truncation for r in C.truncation(df, **k).collect()}
    plain, spared = run(), run(tss_score="tss")
    assert plain["300-400"] == "yes" and spared.pop("300-400") == "no"
    assert all(spared[x] == plain[x] for x in spared) and spared["100-200"] == "yes"
