"""Reference-guided graph filters, categories and truncation against plain Python, locus by locus."""

import random

import pytest
from pyspark.sql import functions as F

from isoloom.operators import chains as C
from isoloom.operators import guided as H

SCHEMA = "Chr string, Strand string, Group long, SSC string, frequency long, known boolean"


def made(seed=3, n=220):
    rng = random.Random(seed)
    out = {}
    for _ in range(n):
        g = rng.randint(1, 8)
        pool = sorted({rng.choice([0, 100, 105, 120, 128, 200, 209, 230, 400, 412, 430, 600]) + g * 10_000 for _ in range(rng.choice([2, 4, 4, 6, 6, 8]))})
        pool = pool[: len(pool) // 2 * 2]
        if pool:
            out["c", "+-"[g % 2], g, "-".join(map(str, pool))] = (rng.choice([1, 2, 5, 30, 200]), g % 3 > 0 and rng.random() < 0.3)
    return [(*k, *v) for k, v in out.items()]


def by_locus(rows):
    out = {}
    for r in rows:
        out.setdefault(r[:3], []).append(([int(x) for x in r[3].split("-")], r[4], r[5]))
    for k, chains in out.items():
        lo, hi = min(s[0] for s, _, _ in chains) - 100, max(s[-1] for s, _, _ in chains) + 100
        out[k] = [(s, [lo, *s, hi], f, known) for s, f, known in chains], any(x[2] for x in chains)
    return out


def brute_sites(rows, apart, free, limit):
    out = set()
    for k, (chains, guided) in by_locus(rows).items():
        f, known = {}, set()
        for s, _, n, is_known in chains:
            for x in s:
                f[x] = f.get(x, 0) + n
                if is_known:
                    known.add(x)
        at = sorted(f)
        for a, b in zip(at, at[1:]):
            low = a if f[a] <= f[b] else b
            if b - a <= apart and min(f[a], f[b]) / max(f[a], f[b]) <= (limit if guided else free) and low not in known:
                out.add((*k, low))
    return out


def brute_jumps(rows, little, free, limit):
    out = set()
    for k, (chains, guided) in by_locus(rows).items():
        over, jump = {}, {}
        for _, e, n, known in chains:
            for i in range(len(e) - 1):
                jump[e[i], e[i + 1]] = jump.get((e[i], e[i + 1]), 0) + n
            for i in range(1, len(e) - 3, 2):
                if e[i + 2] - e[i + 1] <= little:
                    over.setdefault((e[i], e[i + 3]), []).append((n, e[i : i + 4], known))
        for ends, paths in over.items():
            if ends in jump:
                total, j = sum(p[0] for p in paths), jump[ends]
                known = guided and any(p[2] for p in paths)
                if min(total, j) / max(total, j) < (limit if guided else free):
                    if total >= j:
                        out.add((*k, ends))
                    elif not known:
                        out.add((*k, tuple(min(p[:2] for p in paths)[1])))
    return out


def brute_misaligned(rows, little, apart, free, limit):
    out = set()
    for k, (chains, guided) in by_locus(rows).items():
        most = limit if guided else free
        for _, e6, f6, known6 in chains:
            for i in range(0, len(e6) - 6, 2):
                p = e6[i : i + 6]
                if p[3] - p[2] > little:
                    continue
                for _, e4, f4, known4 in chains:
                    for j in range(len(e4) - 3):
                        q = e4[j : j + 4]
                        if (q[0], q[3]) != (p[0], p[5]) or not set(q) - set(p) or abs(sum(p[1::2]) - sum(p[::2]) - sum(q[1::2]) + sum(q[::2])) > apart:
                            continue
                        if (known6 or not guided) and f4 / f6 < most:
                            out.add((*k, tuple(q[1:3])))
                        if (known4 or not guided) and f6 / f4 < most:
                            out.add((*k, tuple(p[1:5])))
    return out


@pytest.fixture(scope="module")
def rows():
    return made()


@pytest.fixture(scope="module")
def df(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def fragments(out):
    return {(r.Chr, r.Strand, r.Group, tuple(r.fragment)) for r in out.collect()}


def test_error_sites(df, rows):
    for apart, free, limit in ((10, 0.05, 0.1), (12, 0.5, 1.0)):
        want = brute_sites(rows, apart, free, limit)
        assert (want or free < 0.1) and {tuple(r) for r in H.error_sites(df, apart, free, limit).collect()} == want


def test_jumps(df, rows):
    for little, free, limit in ((30, 0.05, 0.1), (130, 0.6, 0.9)):
        want = brute_jumps(rows, little, free, limit)
        assert want and fragments(H.jump_errors(df, little, free, limit)) == want
    assert {len(x[3]) for x in brute_jumps(rows, 130, 0.6, 0.9)} == {2, 4}


def test_misaligned(df, rows):
    for little, apart, free, limit in ((30, 40, 0.5, 0.5), (130, 300, 0.9, 1.1)):
        want = brute_misaligned(rows, little, apart, free, limit)
        assert want and fragments(H.misaligned_errors(df, little, apart, free, limit)) == want
    assert {len(x[3]) for x in brute_misaligned(rows, 130, 300, 0.9, 1.1)} == {2, 4}


def test_known_sites_are_left_alone(spark):
    rows = [("c", "+", 0, "100-200", 1000, False), ("c", "+", 0, "105-200", 1, True), ("c", "+", 0, "100-209", 1, False), ("c", "+", 1, "100-200", 1000, False), ("c", "+", 1, "105-200", 1, False)]
    got = {tuple(r) for r in H.error_sites(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == {("c", "+", 0, 209), ("c", "+", 1, 105)}


def test_drivers(spark, df, rows):
    raw = df.drop("known")
    known = raw.join(spark.createDataFrame([r[:4] for r in rows if r[5]], "Chr string, Strand string, Group long, SSC string"), ["Chr", "Strand", "Group", "SSC"], "left_semi")
    chains = raw.where("frequency >= 2")
    out = H.filter_graph(raw, chains, known)
    assert out.columns == [*chains.columns, "category"]
    got = {(r.Chr, r.Strand, r.Group, r.SSC): r.category for r in out.collect()}
    marks = {r[:4] for r in rows if r[5]}
    assert all((v == "FSM") == (k in marks) for k, v in got.items())
    bad = brute_sites([r for r in rows if r[4] >= 2 or r[5]], 10, 0.05, 0.1)
    assert not any((*k[:3], int(s)) in bad for k in got for s in k[3].split("-"))
    free = H.filter_graph(raw, chains)
    assert free.columns == chains.columns and 0 < free.count() < chains.count()
    assert H.filter_graph(raw.limit(0), chains.limit(0), known).count() == 0


def test_categories(spark, df, rows):
    marks = {r[:4] for r in rows if r[5]}
    sites = {}
    for r in marks:
        sites.setdefault(r[:3], set()).update(r[3].split("-"))
    want = {r[:4]: "FSM" if r[:4] in marks else "NIC" if set(r[3].split("-")) <= sites.get(r[:3], set()) else "NNC" for r in rows}
    out = C.categories(df.withColumn("site", F.lit(1)), df.where("known").withColumn("extra", F.lit(1)))
    assert {(r.Chr, r.Strand, r.Group, r.SSC): r.category for r in out.collect()} == want and set(want.values()) == {"FSM", "NIC", "NNC"}
    assert out.columns == [*df.columns, "site", "category"] and C.categories(df.limit(0), df).count() == 0
    assert {r.category for r in C.categories(df, df.limit(0)).collect()} == {"NNC"}


def test_truncation(df, rows):
    want = {}
    for k, (chains, _) in by_locus(rows).items():
        for s, _, n, _ in chains:
            introns = [tuple(s[i : i + 2]) for i in range(0, len(s), 2)]
            inside = 0
            for t, _, m, _ in chains:
                other = [tuple(t[i : i + 2]) for i in range(0, len(t), 2)]
                if len(other) > len(introns) and any(other[i : i + len(introns)] == introns for i in range(len(other))):
                    inside += m
            strong = inside and n / (n + inside) >= 0.5 and n / sum(x[2] for x in chains) >= 0.2
            want[(*k, "-".join(map(str, s)))] = "no" if not inside or strong else "yes"
    got = {(r.Chr, r.Strand, r.Group, r.SSC): r.truncation for r in C.truncation(df, locus_share=0.2).collect()}
    assert got == want and set(want.values()) == {"yes", "no"}
    assert C.truncation(df.limit(0)).count() == 0


def test_drop_truncated(spark):
    rows = [("c", "+", "1-2", "no"), ("c", "+", "1-3", "yes"), ("c", "+", "1-4", "yes"), ("c", "-", "1-4", "yes"), ("c", "+", "1-5", None), ("c", "+", "1-6", None)]
    df = spark.createDataFrame(rows, "Chr string, Strand string, SSC string, truncation string")
    ref = spark.createDataFrame([("c", "+", t, 1) for t in ("1-2", "1-2", "1-4", "1-5")], "Chr string, Strand string, SSC string, n int")
    assert sorted(r.SSC for r in C.drop_truncated(df, ref).collect()) == ["1-2", "1-4", "1-5"]
    assert [r.SSC for r in C.drop_truncated(df).collect()] == ["1-2"] and C.drop_truncated(df.limit(0), ref).count() == 0
