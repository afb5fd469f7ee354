"""Loci by bins and components of graphs, against plain Python."""

import random

from pyspark.sql import functions as F

from isoloom.operators import chains as C
from isoloom.operators import graphs
from isoloom.operators import termini as T


def brute_loci(rows):
    """{chain: Group} of (Chr, Strand, SSC)."""
    placed = sorted((c, s, min(x), max(x), t) for c, s, t in rows for x in [[int(y) for y in t.split("-")]])
    out, group, last = {}, -1, None
    for c, s, lo, hi, t in placed:
        if last is None or (c, s) != last[:2] or lo > last[2]:
            group, last = group + 1, (c, s, hi)
        last = (c, s, max(last[2], hi))
        out[c, s, t] = group
    return out


def ours(spark, rows, width):
    df = spark.createDataFrame(rows, "Chr string, Strand string, SSC string").repartition(3)
    return {(r.Chr, r.Strand, r.SSC): r.Group for r in C.loci(df, width).collect()}


def test_loci(spark):
    rng = random.Random(6)
    rows = {(f"chr{rng.randint(1, 3)}", rng.choice("+-"), f"{a}-{a + rng.choice([1, 5, 40, 700])}") for a in (rng.randint(0, 9000) for _ in range(300))}
    # one span over very many bins, with all others of its strand inside or far behind it
    rows |= {("chr9", "+", "10-5000"), ("chr9", "+", "4000-4100"), ("chr9", "+", "5000-5010"), ("chr9", "+", "5011-5020"), ("chr9", "+", "90000-90001")}
    rows = sorted(rows)
    want = brute_loci(rows)
    for width in (1, 7, 100, 10**6):
        assert ours(spark, rows, width) == want
    assert [want["chr9", "+", x] - want["chr9", "+", "10-5000"] for x in ("4000-4100", "5000-5010", "5011-5020", "90000-90001")] == [0, 0, 1, 2]


def test_loci_of_odd_rows(spark):
    assert ours(spark, [], 10) == {}
    df = spark.createDataFrame([("c", "+", None, 1), ("c", "+", "x", 2), ("c", "+", "5-9", 3), ("c", "+", "5-9", 4)], "Chr string, Strand string, SSC string, n int")
    got = C.loci(df.withColumn("a.b", F.lit(1)))
    assert sorted((r.n, r.Group) for r in got.collect()) == [(3, 0), (4, 0)] and got.columns == ["Chr", "Strand", "SSC", "n", "a.b", "Group"]


def brute_components(edges):
    near = {}
    for k, u, v in edges:
        if u is not None and v is not None:
            near.setdefault((k, u), set()).add((k, v))
            near.setdefault((k, v), set()).add((k, u))
    out = set()
    for node in near:
        seen, todo = {node}, [node]
        while todo:
            new = near[todo.pop()] - seen
            seen |= new
            todo += new
        out.add((*node, min(seen)[1]))
    return out


def test_components(spark):
    rng = random.Random(8)
    edges = [(rng.randint(1, 4), rng.randint(1, 60), rng.randint(1, 60)) for _ in range(110)]
    edges += [(9, i, i + 1) for i in range(40)] + [(9, 100, 100), (9, 7, 7), (9, 200, 201), (9, 201, 200), (9, None, 3), (9, 300, None)]
    edges += [(10, 0, i) for i in range(1, 200)]  # a hub
    df = spark.createDataFrame(edges, "k int, u long, v long").repartition(4).withColumn("a", F.lit("x")).withColumn("m", F.lit(1))
    got = [tuple(r) for r in graphs.components(df, by=["k"]).collect()]
    assert len(got) == len(set(got)) and set(got) == brute_components(edges)
    # without a key, nodes of equal names are one
    flat = {tuple(r) for r in graphs.components(df.select(F.col("u").alias("p"), F.col("v").alias("q")), "p", "q").collect()}
    assert flat == {(n, c) for _, n, c in brute_components([(0, u, v) for _, u, v in edges])}
    assert graphs.components(df.limit(0), by=["k"]).count() == 0


def test_reads_are_corrected_within_100(spark):
    read = lambda s, e: ("c", "+", "10-20", s, e)
    schema = "Chr string, Strand string, SSC string, TrStart long, TrEnd long"
    model = spark.createDataFrame([("c", "+", "10-20", 1000, 5000)], schema)
    reads = spark.createDataFrame([read(920, 5000), read(900, 5000), read(899, 5000), read(930, 5070), read(1060, 4920), read(940, 5081)], schema)
    got = sorted((r.TrStart, r.TrEnd) for r in T.correct_reads(reads, model).collect())
    assert got == sorted([(1000, 5000)] * 4 + [(899, 5000), (940, 5081)])


def test_reference_and_chains_have_one_numbering(spark):
    schema = "Chr string, Strand string, SSC string, Group long"
    chains = spark.createDataFrame([("a", "+", "500-600", 9), ("b", "+", "5-6", 9)], schema)
    # loci of the reference alone lie before those of the chains
    reference = spark.createDataFrame([("a", "+", "1-2", 0), ("a", "+", "550-700", 1), ("a", "+", "500-600", 1), ("c", "-", "1-2", 2)], schema)
    c, r = C.loci_with(chains, reference)
    assert sorted((x.Chr, x.SSC, x.Group) for x in c.collect()) == [("a", "500-600", 1), ("b", "5-6", 2)]
    assert sorted((x.Chr, x.SSC, x.Group) for x in r.collect()) == [("a", "1-2", 0), ("a", "500-600", 1), ("a", "550-700", 1), ("c", "1-2", 3)]
    assert {x.SSC: x.category for x in C.categories(c, r).collect()} == {"500-600": "FSM", "5-6": "NNC"}


def test_counted_reads_have_the_same_ends(spark):
    rng = random.Random(2)
    rows = [("c", "+", t, 100 * rng.randint(0, 2) + rng.randint(0, 9), 900 + 100 * rng.randint(0, 1) + rng.randint(0, 9)) for t in ("10-20", "10-30") for _ in range(300)]
    reads = spark.createDataFrame(rows, "Chr string, Strand string, SSC string, TrStart long, TrEnd long")
    counted = reads.groupBy(*reads.columns).count()
    listed = lambda df: sorted(map(tuple, df.collect()))
    assert listed(T.terminal_pairs(reads)) == listed(T.terminal_pairs(counted, "count"))
    for side in ("start", "end"):
        assert listed(T.terminal_sites(reads, side)) == listed(T.terminal_sites(counted, side, "count"))


def test_correction_reads_each_read_twice(spark, tmp_path):
    """Once for its chain and once to be moved: ends of a chain come to its reads in one join."""
    rows = [("c1", "+", "10-20", 5, 30), ("c1", "+", "12-20", 500, 600), ("c1", "+", None, 1, 2), ("c1", "+", "11-20", None, 30)]
    spark.createDataFrame(rows, "Chr string, Strand string, SSC string, TrStart bigint, TrEnd bigint").write.parquet(str(tmp_path / "reads"))
    model = spark.createDataFrame([("c1", "+", "10-20", s, e) for s, e in ((4, 31), (6, 31), (6, 31), (300, 600))], "Chr string, Strand string, SSC string, TrStart bigint, TrEnd bigint")
    out = T.correct_reads(spark.read.parquet(str(tmp_path / "reads")), model)
    assert out._jdf.queryExecution().optimizedPlan().toString().count("parquet") == 2
    got = sorted((tuple(r) for r in out.collect()), key=str)
    assert got == sorted([("c1", "+", "10-20", 4, 31), ("c1", "+", "10-20", 500, 600), ("c1", "+", "10-20", None, 30)], key=str)


def test_clusters_keep_running_values_only(spark):
    """Values are joined once, to what was found of them, and no frame goes from each value to the last one."""
    rng = random.Random(4)
    rows = [("c", rng.choice((50, 400, 430)) + rng.randint(-20, 20)) for _ in range(400)] + [("c", None), (None, 50), ("d", 7)]
    df = spark.createDataFrame(rows, "k string, v long")
    out = T.clusters(df, ["k"], "v")
    plan = out._jdf.queryExecution().optimizedPlan().toString().lower()
    assert plan.count("join") == 1 and "unboundedfollowing" not in plan.replace("unboundedpreceding$(), unboundedfollowing", "")
    values = [v for k, v in rows if k == "c" and v is not None]
    core = sorted(v for v in set(values) if sum(abs(x - v) <= 15 for x in values) >= 40)
    of = {v: sum(b - a > 15 for a, b in zip(core, core[1:]) if b <= v) for v in core}
    near = lambda v: of.get(min(core, key=lambda c: (abs(c - v), c)) if any(abs(c - v) <= 15 for c in core) else None)
    assert len(set(of.values())) > 1
    assert sorted(map(tuple, out.collect()), key=str) == sorted([("c", v, near(v)) for v in values] + [("d", 7, None)], key=str)


def test_paired_reads_are_read_as_they_lie(spark, tmp_path):
    """Pairs of ends that are counted already are not counted again; reads are moved in one join, and those
    whose chains are known are read once."""
    rng = random.Random(6)
    rows = [("c", "+", t, 100 * rng.randint(0, 2) + rng.randint(0, 9), 900 + 100 * rng.randint(0, 1) + rng.randint(0, 9)) for t in ("10-20", "12-20", "10-90") for _ in range(200)]
    rows += [("c", "-", "10-20", 3, 50), ("c", "-", "10-20", None, 60), (None, "-", "10-20", 1, 9)]
    reads = spark.createDataFrame(rows, "Chr string, Strand string, SSC string, TrStart long, TrEnd long")
    reads.groupBy(*reads.columns).agg(F.count("*").alias("n")).write.parquet(str(tmp_path / "reads"))
    counted = spark.read.parquet(str(tmp_path / "reads"))
    listed = lambda df: sorted(map(tuple, df.collect()), key=str)
    pairs = listed(T.terminal_pairs(reads))
    assert listed(T.terminal_pairs(counted, "n", paired=True)) == pairs and len(pairs) > 6
    columns = ["Chr", "Strand", "SSC", "TrStart", "TrEnd"]
    model = spark.createDataFrame([p[:5] for p in pairs if p[2] != "12-20"], reads.schema)
    chains = spark.createDataFrame([(c, s, t) for c, s, t in {r[:3] for r in rows}], "Chr string, Strand string, SSC string")
    out = T.correct_reads(counted, model, chains=chains)
    assert out._jdf.queryExecution().optimizedPlan().toString().count("parquet") == 1
    assert listed(out) == listed(T.correct_reads(counted, model))
    assert {r.SSC for r in out.where("Strand = '+'").select(*columns).collect()} == {"10-20", "10-90"}
