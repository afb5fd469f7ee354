"""Annotation by locus against plain Python, a test for each route."""

import hashlib
import random
from collections import Counter

from pyspark.sql import functions as F

from isoloom.operators import annotate as N
from isoloom.stages import Staged, numbered

PLACE = "Chr string, Strand string, SSC string, TrStart long, TrEnd long, "
TX, REF = PLACE + "frequency long", PLACE + "TrID string, GeneID string, GeneName string"


def sites(t):
    return [int(x) for x in t.split("-")]


def brute(rows, reference, tolerance=50, least=2):
    """{place: (uniqueTr, TrID, GeneID, GeneName, route)} before suffixes and remapping."""
    places = sorted({r[:5] for r in rows})
    name = {p: f"Tr{i}" for i, p in enumerate(places)}
    group, last, g = {}, None, -1
    for p in sorted(places, key=lambda p: (p[0], p[1], min(sites(p[2])), max(sites(p[2])))):
        lo, hi = min(sites(p[2])), max(sites(p[2]))
        if last is None or p[:2] != last[0] or lo > last[1]:
            g, last = g + 1, (p[:2], hi)
        last = (p[:2], max(hi, last[1]))
        group[p] = g
    out, of = {}, {}
    for p in places:
        refs = [r for r in reference if r[:3] == p[:3]]
        if refs:
            near = [r for r in refs if abs(r[3] - p[3]) <= tolerance and abs(r[4] - p[4]) <= tolerance]
            flag = ""
            if not near:
                s, e = (min((abs(r[i] - p[i]), r[i])[0] for r in refs) > tolerance for i in (3, 4))
                tss, tes = (e, s) if p[1] == "-" else (s, e)
                flag = "_AlterTssTes" if tss and tes else "_AlterTss" if tss else "_AlterTes" if tes else ""
            of[p] = near or refs
            ids = lambda i: sorted({r[i] for r in of[p]})  # noqa: B023, E731
            out[p] = (name[p], "_".join(ids(5)) + flag, "-".join(ids(6)), "-".join(ids(7)), "reference")
    for p in places:
        if p not in out:
            mine, counts = {p[3], p[4], *sites(p[2])}, Counter()
            have = {}
            for q, refs in of.items():
                if group[q] == group[p]:
                    for r in refs:
                        have.setdefault((r[6], r[7]), set()).update([q[3], q[4], *sites(q[2])])
            for key, theirs in have.items():
                counts[key] = len(mine & theirs)
            best = min(((-n, *k) for k, n in counts.items() if n >= least), default=None)
            gene, gene_name, route = (best[1], best[2], "gene") if best else (f"NovelGene{group[p]}", f"NovelGene{group[p]}", "novel")
            out[p] = (name[p], f"{gene}_Novel{name[p]}", gene, gene_name, route)
    return out


def suffixed(named):
    """TrIDs with suffixes by place as text."""
    out, seen = {}, Counter()
    for p in sorted(named, key=lambda p: f"{p[0]}{p[1]}:{p[3]}-{p[2]}-{p[4]}"):
        u, tid, *rest = named[p]
        seen[tid] += 1
        out[p] = (u, tid if seen[tid] == 1 else f"{tid}_{seen[tid]}", *rest)
    return out


def ours(df):
    return {(r.Chr, r.Strand, r.SSC, r.TrStart, r.TrEnd): (r.uniqueTr, r.TrID, r.GeneID, r.GeneName, r.route) for r in df.collect()}


def made(seed=7):
    rng = random.Random(seed)
    rows, reference = [], []
    for i in range(120):
        a = 1000 * rng.randint(1, 12) + 20 * rng.randint(0, 8)
        ssc = f"{a}-{a + 100}" + (f"-{a + 150}-{a + 300}" if rng.random() < 0.5 else "")
        place = (rng.choice(["c1", "c2"]), rng.choice("+-"), ssc, a - rng.choice([10, 45, 90]), a + rng.choice([400, 420, 500]))
        rows += [(*place, rng.randint(1, 9))] * rng.choice([1, 1, 2])
        if rng.random() < 0.35:
            for k in range(rng.choice([1, 1, 2])):
                reference.append((*place[:3], place[3] + rng.choice([0, 30, 70]), place[4] - rng.choice([0, 60]), f"R{i}{'x' * k}" if rng.random() < 0.9 else "R", f"G{a // 1000}{'b' * k}", f"N{a // 1000}{'b' * k}"))
    return rows, reference


def test_against_plain_python(spark):
    rows, reference = made()
    df, ref = spark.createDataFrame(rows, TX).repartition(3), spark.createDataFrame(reference, REF).repartition(2)
    got = ours(N.annotate(df, ref, remap=False))
    want = suffixed(brute(rows, reference))
    assert got == want
    assert {v[4] for v in want.values()} == {"reference", "gene", "novel"} and any("Alter" in v[1] for v in want.values())
    assert len({v[1] for v in got.values()}) == len(got)
    assert all(not v[2].startswith("NovelGene") or "_" not in v[2] for v in ours(N.annotate(df, ref)).values())


def test_one_reference(spark):
    t = spark.createDataFrame([("c", "+", "20-30", 10, 40, 1), ("c", "+", "20-30", 10, 40, 2), ("c", "-", "20-30", 10, 40, 1)], TX)
    ref = spark.createDataFrame([("c", "+", "20-30", 12, 44, "R", "G", None), ("c", "-", "20-30", 10, 400, "Q", "H", "h")], REF)
    got = ours(N.annotate(t, ref))
    assert got == {("c", "+", "20-30", 10, 40): ("Tr0", "R", "G", "G", "reference"), ("c", "-", "20-30", 10, 40): ("Tr1", "Q_AlterTss", "H", "h", "reference")}
    assert [r.frequency for r in N.annotate(t, ref).where("Strand = '+'").collect()] == [1]


def test_several_references(spark):
    t = spark.createDataFrame([("c", "+", "20-30", 10, 40, 1)], TX)
    refs = [("c", "+", "20-30", 11, 40, "b", "G2", "n2"), ("c", "+", "20-30", 10, 41, "a", "G1", "n1"), ("c", "+", "20-30", 900, 41, "z", "G9", "n9")]
    assert [*ours(N.annotate(t, spark.createDataFrame(refs, REF))).values()] == [("Tr0", "a_b", "G1-G2", "n1-n2", "reference")]


def test_best_gene_and_novel(spark):
    rows = [("c", "+", "20-30", 10, 40, 1), ("c", "+", "20-35", 10, 40, 1), ("c", "+", "22-33", 9, 41, 1), ("c", "+", "500-600", 1, 9, 1)]
    ref = spark.createDataFrame([("c", "+", "20-30", 10, 40, "R", "G_1", "name")], REF)
    got = ours(N.annotate(spark.createDataFrame(rows, TX), ref, remap=False))
    assert {k[2]: v[1:] for k, v in got.items()} == {"20-30": ("R", "G_1", "name", "reference"), "20-35": ("G_1_NovelTr1", "G_1", "name", "gene"), "22-33": ("NovelGene0_NovelTr2", "NovelGene0", "NovelGene0", "novel"), "500-600": ("NovelGene1_NovelTr3", "NovelGene1", "NovelGene1", "novel")}
    alone = ours(N.annotate(spark.createDataFrame(rows, TX)))
    assert {v[4] for v in alone.values()} == {"novel"} and {v[2] for v in alone.values()} == {"NovelGene0", "NovelGene1"}
    none = spark.createDataFrame([], TX)
    assert N.annotate(none, ref).count() == 0 and N.annotate(spark.createDataFrame(rows, TX), ref.limit(0)).where("route = 'novel'").count() == 4
    odd = spark.createDataFrame([("c", "+", None, 1, 2, 3), ("c", "+", "5-6", None, 2, 3)], TX)
    assert N.annotate(odd, ref).count() == 0


def test_suffixes_stay_unique(spark):
    named = spark.createDataFrame([("c", "+", "1-2", i, 9, f"Tr{i}", tid) for i, tid in enumerate(["A", "A", "A_2", "A", "B"])], PLACE + "uniqueTr string, TrID string")
    got = {r.uniqueTr: r.TrID for r in N.unique_ids(named).collect()}
    assert got == {"Tr0": "A", "Tr1": "A_2_Tr1", "Tr2": "A_2", "Tr3": "A_3", "Tr4": "B"}


def test_long_ids(spark):
    ids = [f"ENST{i:011d}" for i in range(30)]
    digest = lambda x: hashlib.sha1("\n".join(sorted(x)).encode()).hexdigest()[:12]
    df = spark.createDataFrame([(ids[::-1], [*ids, "NovelGene1"], ["ä" * 90, "b" * 150], ["x", "a"])], "a array<string>, b array<string>, c array<string>, d array<string>")
    r = df.select(N.joined_transcripts(F.col("a")), N.joined_genes(F.col("a")), N.joined_genes(F.col("b")), N.joined_transcripts(F.col("c")), N.joined_transcripts(F.col("d")), N.joined_genes(F.col("d"))).first()
    assert tuple(r) == (f"{ids[0]}_and_29_more_{digest(ids)}", f"FusionGene_{digest(ids)}", f"NovelGeneCluster_Fusion_{digest([*ids, 'NovelGene1'])}", "b" * 100 + f"_and_1_more_{digest(['ä' * 90, 'b' * 150])}", "a_x", "a-x")


def test_numbers(spark):
    df = spark.range(100).select((F.col("id") * 37 % 50).alias("k")).repartition(5)
    got = numbered(df, ["k"], "n", Staged(spark, "test")).collect()
    assert sorted(r.n for r in got) == list(range(100)) and [r.k for r in sorted(got, key=lambda r: r.n)] == sorted(r.k for r in got)
    assert numbered(df.limit(0), ["k"], "n", Staged(spark, "test")).count() == 0
