"""GTF features against a walk base by base, and against known rows."""

import random

from pyspark.sql import functions as F

from isoloom.operators import quantify as Q

SCHEMA = "Chr string, Strand string, TrStart long, TrEnd long, TrID string, GeneID string, GeneName string, SSC string, TrStart_ref long, TrEnd_ref long, Predict_NMD string, TIS_related_location long, TTS_related_location long"


def stretches(places):
    """Runs of the sorted places."""
    out = []
    for x in sorted(places):
        if out and out[-1][1] == x - 1:
            out[-1][1] = x
        else:
            out.append([x, x])
    return [tuple(x) for x in out]


def cut(sites, start, end):
    sites = sites[: len(sites) // 2 * 2]
    ends = [start, *sites, end]
    return [(ends[i], ends[i + 1]) for i in range(0, len(ends), 2)]


def brute(row, by_strand=False):
    """Sorted (feature, s, e, phase, number) of a transcript."""
    _, strand, start, end, _, _, _, ssc, rs, re, nmd, tis, tts = row
    sites = [int(x) for x in ssc.split("-")] if ssc else []
    own, ref = cut(sites, start, end), cut(sites, rs, re)
    bases = [b for s, e in own for b in range(s, e + 1)]
    bases = bases[::-1] if strand == "-" else bases
    out = [("transcript", rs, re, ".", None)]
    codes = nmd == "Normal" and tis is not None and tts is not None and 0 <= tis and tis + 1 < tts <= len(bases)
    out += [("exon", s, e, ".", i) for i, (s, e) in enumerate(own if codes else ref, 1)]
    for i, ((_, a), (b, _)) in enumerate(zip(ref, ref[1:]), 1):
        left, right = (a + 1, a + 2), (b - 2, b - 1)
        donor, acceptor = (right, left) if strand == "-" else (left, right)
        out += [("donor_site", *donor, ".", i), ("acceptor_site", *acceptor, ".", i)]
    if codes:
        inside = lambda places: [x for s, e in own for x in stretches(p for p in places if s <= p <= e)]
        before, code, behind = inside(bases[:tis]), inside(bases[tis : tts - 1]), inside(bases[tts - 1 :])
        out += [("CDS", s, e, "0", None) for s, e in code] + [("UTR", s, e, ".", None) for s, e in before + behind]
        five, three = (behind, before) if strand == "-" and not by_strand else (before, behind)
        out += [("UTR5", s, e, ".", None) for s, e in five] + [("UTR3", s, e, ".", None) for s, e in three]
        a, z = bases[tis], bases[tts - 1]
        out += [("start_codon", *((a - 2, a) if strand == "-" else (a, a + 2)), ".", None), ("stop_codon", z - 1, z + 1, ".", None)]
    return sorted(out, key=str)


def made(n=120, seed=4):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        start = rng.randint(100, 200)
        sites, at = [], start
        for _ in range(rng.choice([0, 2, 4, 6, 3])):
            at += rng.randint(3, 30)
            sites.append(at)
        end = at + rng.randint(3, 30)
        tis = rng.choice([None, 0, 1, rng.randint(0, 60)])
        out.append((f"chr{i % 2}", rng.choice("+-"), start, end, f"t{i}", f"g{i // 4}", None, "-".join(map(str, sites)) or None, start - rng.choice([0, 5]), end + rng.choice([0, 7]), rng.choice(["Normal", "Normal", "Normal", "NMD", None]), tis, rng.choice([None, (tis or 0) + rng.randint(0, 70)])))
    return out


def found(df, **how):
    out = {}
    for r in Q.gtf_features(df, **how).where("feature <> 'gene'").collect():
        number = [x.split('"')[1] for x in r.attributes.split("; ") if "_number" in x]
        out.setdefault(r.tx, []).append((r.feature, r.s, r.e, r.phase, int(number[0]) if number else None))
    return {k: sorted(v, key=str) for k, v in out.items()}


def test_against_a_walk(spark):
    rows = made()
    df = spark.createDataFrame(rows, SCHEMA)
    assert found(df) == {r[4]: brute(r) for r in rows}
    assert found(df, by_strand=True) == {r[4]: brute(r, True) for r in rows}
    assert any(x[0] == "CDS" for r in rows for x in brute(r) if r[1] == "-")


def test_lines(spark):
    rows = [
        ("chr1", "+", 1000, 4000, "G1_t1", "G1", "GENEA", "2000-3000", 1000, 4000, "Normal", 10, 1500),
        ("chr1", "+", 1000, 3500, "G1_t2", "G1", "GENEA", "2000-3000", 1000, 3500, "no", None, None),
        ("chr2", "-", 5000, 6000, "G2_t1", "G2", "GENEB", "5500", 5000, 6000, "no", None, None),
    ]
    df = spark.createDataFrame(rows + rows[:1], SCHEMA).repartition(3)
    got = [r.value.split("\t") for r in Q.gtf_lines(Q.gtf_features(df, "made")).collect()]
    first = [("transcript", 1000, 4000), ("exon", 1000, 2000), ("exon", 3000, 4000), ("CDS", 1010, 2000), ("CDS", 3000, 3497), ("UTR", 1000, 1009), ("UTR5", 1000, 1009), ("UTR", 3498, 4000), ("UTR3", 3498, 4000), ("start_codon", 1010, 1012), ("stop_codon", 3497, 3499), ("donor_site", 2001, 2002), ("acceptor_site", 2998, 2999)]
    second = [("transcript", 1000, 3500), ("exon", 1000, 2000), ("exon", 3000, 3500), ("donor_site", 2001, 2002), ("acceptor_site", 2998, 2999)]
    want = [("gene", 1000, 4000), *second, *first, ("gene", 5000, 6000), ("transcript", 5000, 6000), ("exon", 5000, 6000)]
    assert [(x[2], int(x[3]), int(x[4])) for x in sorted(got, key=lambda x: x[0])] and sorted((x[2], int(x[3]), int(x[4])) for x in got) == sorted(want)
    # transcripts of one start stand in the order of their ids
    assert [x[2] for x in got] == ["gene", *[f for f, _, _ in first], *[f for f, _, _ in second], "gene", "transcript", "exon"]
    assert got[0] == ["chr1", "made", "gene", "1000", "4000", ".", "+", ".", 'gene_id "G1"; gene_name "GENEA";']
    assert got[2][8] == 'gene_id "G1"; transcript_id "G1_t1"; gene_name "GENEA"; exon_number "1";' and [x[7] for x in got if x[2] == "CDS"] == ["0", "0"]
    assert got[12][8].endswith('gene_name "GENEA"; junction_number "1";')


def test_odd_rows(spark):
    bare = spark.createDataFrame([("c", "+", 1, 50, "t", "g", "10-20"), ("c", "+", None, 50, "u", "g", "10-20"), ("c", "+", 1, 50, None, "g", None)], "Chr string, Strand string, TrStart long, TrEnd long, TrID string, GeneID string, SSC string")
    got = [(r.feature, r.s, r.e, r.attributes) for r in Q.gtf_features(bare).orderBy("prio", "s").collect()]
    assert [x[:3] for x in got] == [("gene", 1, 50), ("transcript", 1, 50), ("exon", 1, 10), ("exon", 20, 50), ("donor_site", 11, 12), ("acceptor_site", 18, 19)]
    assert got[0][3] == 'gene_id "g"; gene_name "g";'
    assert Q.gtf_features(bare.limit(0)).count() == 0
    more = bare.withColumn("own", F.lit(1)).withColumn("f", F.lit(2)).withColumn("a.b", F.lit(3)).withColumn("at", F.lit(3))
    assert Q.gtf_features(more).count() == 6
