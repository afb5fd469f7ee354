"""Reads to chains, loci and filtered chains."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from isoloom.functions import chain
from isoloom.stages import Staged

KEY = ["Chr", "Strand", "SSC"]
LOCUS = ["Chr", "Strand", "Group"]
CANONICAL = ("GT-AG", "AT-AC", "GC-AG")


def good_reads(reads: DataFrame, identity: float = 0.95, coverage: float = 0.0) -> DataFrame:
    """Reads with both values at or over their limits; null values fail."""
    return reads.where((F.col("identity") >= identity) & (F.col("coverage") >= coverage))


def collapse(reads: DataFrame, by: tuple[str, ...] = (), with_reads: bool = False) -> DataFrame:
    """Spliced reads to chains with their number and outermost ends. ``by`` adds keys
    such as sample; ``with_reads`` adds the read ends as an array, which a chain with
    very many reads makes long."""
    aggs = [F.count("*").alias("frequency"), F.min("TrStart").alias("lo"), F.max("TrEnd").alias("hi")]
    if with_reads:
        aggs.append(F.sort_array(F.collect_list(F.struct("TrStart", "TrEnd"))).alias("reads"))
    return reads.where("SSC is not null").groupBy(*by, *KEY).agg(*aggs)


def mean_ends(reads: DataFrame) -> DataFrame:
    """(chain, mean_start, mean_end) of spliced reads."""
    return reads.where("SSC is not null").groupBy(*KEY).agg(F.avg("TrStart").alias("mean_start"), F.avg("TrEnd").alias("mean_end"))


def supported(chains: DataFrame, least: int = 5) -> DataFrame:
    return chains.where(F.col("frequency") >= least)


def loci(chains: DataFrame, width: int = 100_000) -> DataFrame:
    """Adds Group: chains of a strand whose spans overlap, one after another, share it.

    Loci are numbered from 0 by contig, strand and place. Spans, from a chain's smallest site
    to its greatest, are taken once each and sorted within bins of ``width`` bases. What a bin
    must know of those before it, the greatest end and the number of loci, is carried over one
    row a bin, so that no task has a whole contig. Chains without sites are left out; an empty
    table stays empty.
    """
    s = chain.sites(F.col("SSC"))
    placed = chains.withColumns({"_s": F.array_min(s), "_e": F.array_max(s)})
    spans = placed.where("_s is not null").select("Chr", "Strand", "_s", "_e", F.floor(F.col("_s") / width).alias("_bin")).distinct()
    strand = ["Chr", "Strand"]
    earlier = Window.partitionBy(*strand).orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1)
    ends = spans.groupBy(*strand, "_bin").agg(F.max("_e").alias("_last")).select(*strand, "_bin", F.max("_last").over(earlier).alias("_reach"))
    here = Window.partitionBy(*strand, "_bin").orderBy("_s", "_e")
    reach = F.greatest(F.max("_e").over(here.rowsBetween(Window.unboundedPreceding, -1)), F.col("_reach"))
    spans = spans.join(ends, [*strand, "_bin"]).withColumn("_new", F.coalesce((F.col("_s") > reach).cast("long"), F.lit(0)))
    spans = spans.withColumn("_local", F.sum("_new").over(here.rowsBetween(Window.unboundedPreceding, 0)))
    bins = spans.groupBy(*strand, "_bin").agg(F.max("_local").alias("_n"))
    strands = bins.groupBy(*strand).agg((F.sum("_n") + 1).alias("_n"))  # a row for each contig and strand
    before = F.coalesce(F.sum("_n").over(Window.orderBy(*strand).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    bins = bins.select(*strand, "_bin", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_earlier")).join(strands.select(*strand, before.alias("_before")), strand)
    spans = spans.join(bins, [*strand, "_bin"]).select(*strand, "_s", "_e", (F.col("_local") + F.col("_earlier") + F.col("_before")).alias("Group"))
    return placed.join(spans, [*strand, "_s", "_e"]).drop("_s", "_e")


def loci_with(chains: DataFrame, reference: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both tables with Group, from one numbering of all their chains, so that a locus has one number in
    both; a Group that the reference has already is replaced. The numbering is written once for both."""
    both = loci(chains.select(*KEY).unionByName(reference.select(*KEY)).distinct())
    both = Staged(chains.sparkSession, "numbering").write(both, "both")
    return chains.drop("Group").join(both, KEY), reference.drop("Group").join(both, KEY)


def attach_motifs(chains: DataFrame, motifs: DataFrame) -> DataFrame:
    """Adds junction from (Chr, Strand, SSC, junction); "none" where there is none."""
    return chains.join(motifs, KEY, "left").withColumn("junction", F.coalesce("junction", F.lit("none")))


def screen_motifs(chains: DataFrame, ratio: float = 0.25) -> DataFrame:
    """Drops chains with a motif outside CANONICAL and at most ``ratio`` of their locus' reads."""
    canonical = F.forall(F.split(F.upper("junction"), ","), lambda m: m.isin(*CANONICAL))
    share = F.col("frequency") / F.sum("frequency").over(Window.partitionBy(*LOCUS))
    return chains.withColumn("_share", share).where(canonical | (F.col("_share") > ratio)).drop("_share")


def drop_fragments(chains: DataFrame, least_exon: int = 100, rare: float = 0.01) -> DataFrame:
    """Drops rare chains that are short at an end, where they have one junction, or not canonical.

    Rare: under ``rare`` of the mean frequency of all chains, a single row that is
    broadcast. Ends are the means of the reads' (mean_start, mean_end, as mean_ends
    gives them); motifs are compared in the case they are written in. Chains without
    motif or means are kept unless the other rule drops them.
    """
    s = chain.sites(F.col("SSC"))
    short = (F.size(s) == 2) & (F.least(F.abs(F.element_at(s, 1) - F.col("mean_start")), F.abs(F.col("mean_end") - F.element_at(s, -1))) < least_exon)
    odd = ~F.forall(F.split("junction", ","), lambda m: m.isin(*CANONICAL))
    drop = F.coalesce(short, F.lit(False)) | F.coalesce(odd, F.lit(False))
    mean = chains.agg(F.avg("frequency").alias("_mean"))
    return chains.crossJoin(F.broadcast(mean)).where((F.col("frequency") >= rare * F.col("_mean")) | ~drop).drop("_mean")


def keep_loci(chains: DataFrame, reference: DataFrame | None = None, quantile: float = 0.25) -> DataFrame:
    """Chains of loci with as many reads as the quantile of single chains, or a reference chain."""
    limit = chains.agg(F.percentile("frequency", F.lit(quantile)).alias("_limit"))
    known = F.lit(False)
    table = chains
    if reference is not None:
        table = chains.join(reference.select(*KEY, F.lit(True).alias("_known")).distinct(), KEY, "left")
        known = F.coalesce(F.bool_or("_known"), F.lit(False))
    good = table.groupBy(*LOCUS).agg(F.sum("frequency").alias("_sum"), known.alias("_ref")).crossJoin(F.broadcast(limit)).where("_sum >= _limit or _ref")
    return chains.join(good.select(*LOCUS), LOCUS, "left_semi")


def edge_weights(chains: DataFrame) -> DataFrame:
    """(locus, u, v, weight): share of the locus' reads that go from site u to site v. Chains without sites
    count for the share and have no edge; a locus is never null; an empty table gives no row."""
    share = F.col("frequency") / F.sum("frequency").over(Window.partitionBy(*LOCUS))
    e = chains.withColumn("_share", share).select(*LOCUS, "_share", F.explode(chain.windows(chain.sites(F.col("SSC")), 2)).alias("e"))
    return e.groupBy(*LOCUS, F.col("e")[0].alias("u"), F.col("e")[1].alias("v")).agg(F.sum("_share").alias("weight"))


def degrees(edges: DataFrame) -> DataFrame:
    """(locus, site, out_degree, in_degree) of distinct edges; no edges give no row."""
    ends = edges.select(*LOCUS, F.explode(F.array(F.struct(F.col("u").alias("site"), F.lit(1).alias("o"), F.lit(0).alias("i")), F.struct(F.col("v").alias("site"), F.lit(0).alias("o"), F.lit(1).alias("i")))).alias("x"))
    return ends.groupBy(*LOCUS, "x.site").agg(F.sum("x.o").alias("out_degree"), F.sum("x.i").alias("in_degree"))


def drop_weak_edges_once(chains: DataFrame, weight: float = 0.05, safe: int = 5) -> DataFrame:
    """One round: drops chains under ``safe`` reads that use an edge lighter than ``weight``
    of which an end has no other edge."""
    e = edge_weights(chains)
    d = degrees(e).withColumn("degree", F.col("out_degree") + F.col("in_degree"))
    weak = e.where(F.col("weight") < weight).join(d.select(*LOCUS, F.col("site").alias("u"), F.col("degree").alias("du")), [*LOCUS, "u"]).join(d.select(*LOCUS, F.col("site").alias("v"), F.col("degree").alias("dv")), [*LOCUS, "v"]).where("du = 1 or dv = 1")
    used = chains.where(F.col("frequency") < safe).select(*KEY, "Group", F.explode(chain.windows(chain.sites(F.col("SSC")), 2)).alias("e")).select(*KEY, "Group", F.col("e")[0].alias("u"), F.col("e")[1].alias("v"))
    gone = used.join(weak.select(*LOCUS, "u", "v"), [*LOCUS, "u", "v"], "left_semi").select(*KEY).distinct()
    return chains.join(gone, KEY, "left_anti")


def drop_weak_edges(chains: DataFrame, weight: float = 0.05, safe: int = 5) -> DataFrame:
    """Rounds of drop_weak_edges_once until none drops a chain; each is checkpointed."""
    before = chains.count()
    while True:
        chains = drop_weak_edges_once(chains, weight, safe).checkpoint()
        after = chains.count()
        if after == before:
            return chains
        before = after


def extend(chains: DataFrame, margin: int = 100) -> DataFrame:
    """Adds ext: the sites between the locus' outermost sites moved out by ``margin``."""
    w = Window.partitionBy(*LOCUS)
    s = chain.sites(F.col("SSC"))
    ends = chains.withColumns({"_s": s, "_lo": F.min(F.array_min(s)).over(w), "_hi": F.max(F.array_max(s)).over(w)})
    return ends.withColumn("ext", F.concat(F.array(F.col("_lo") - margin), "_s", F.array(F.col("_hi") + margin))).drop("_s", "_lo", "_hi")


def error_sites(chains: DataFrame, apart: int = 10, ratio: float = 0.05) -> DataFrame:
    """(locus, site): sites within ``apart`` of a neighbour that at least 1 / ratio times as many reads use;
    of equal ones the left. Chains without sites have none; an empty table gives no row."""
    f = extend(chains).select(*LOCUS, F.explode(F.slice("ext", F.lit(2), F.size("ext") - 2)).alias("site"), "frequency").groupBy(*LOCUS, "site").agg(F.sum("frequency").alias("f"))
    w = Window.partitionBy(*LOCUS).orderBy("site")
    near = f.withColumns({"s2": F.lead("site").over(w), "f2": F.lead("f").over(w)}).where(F.col("s2") - F.col("site") <= apart)
    low = near.where(F.least("f", "f2") / F.greatest("f", "f2") <= ratio)
    return low.select(*LOCUS, F.when(F.col("f") <= F.col("f2"), F.col("site")).otherwise(F.col("s2")).alias("site")).distinct()


def drop_sites(chains: DataFrame, bad: DataFrame) -> DataFrame:
    """Chains that use none of the sites (locus, site)."""
    used = chains.select(*KEY, "Group", F.explode(chain.sites(F.col("SSC"))).alias("site"))
    gone = used.join(bad, [*LOCUS, "site"], "left_semi").select(*KEY).distinct()
    return chains.join(gone, KEY, "left_anti")


def _paths(chains: DataFrame, k: int, starts: Column | None = None) -> DataFrame:
    """(locus, p, f): windows of k extended sites that start at an exon end, with their reads."""
    w = F.filter(F.transform(chain.windows(F.col("ext"), k), lambda p: p), lambda p: F.array_position(F.col("ext"), F.get(p, F.lit(0))) % 2 == 0)
    return extend(chains).select(*LOCUS, "frequency", F.explode(w).alias("p")).groupBy(*LOCUS, "p").agg(F.sum("frequency").alias("f"))


def jump_errors(chains: DataFrame, little: int = 30, ratio: float = 0.05) -> DataFrame:
    """(locus, fragment): the rarer of a path over a little exon and the edge that jumps it,
    where it has under ``ratio`` of the other's reads."""
    four = _paths(chains, 4).withColumns({"a": F.col("p")[0], "d": F.col("p")[3]}).where(F.col("p")[2] - F.col("p")[1] <= little)
    two = _paths(chains, 2).select(*LOCUS, F.col("p")[0].alias("a"), F.col("p")[1].alias("d"), F.col("f").alias("jump"))
    both = four.join(two, [*LOCUS, "a", "d"]).where(F.least("f", "jump") / F.greatest("f", "jump") < ratio)
    return both.select(*LOCUS, F.when(F.col("f") < F.col("jump"), F.col("p")).otherwise(F.array("a", "d")).alias("fragment")).distinct()


def misaligned_errors(chains: DataFrame, little: int = 30, apart: int = 10, ratio: float = 0.05) -> DataFrame:
    """(locus, fragment): the rarer of a path with a little exon and one without, between the
    same ends, whose exon lengths differ by ``apart`` at most."""
    size6 = F.col("p")[2] - F.col("p")[1] + F.col("p")[4] - F.col("p")[3]
    six = _paths(chains, 6).where((F.col("p")[2] - F.col("p")[1] <= little) | (F.col("p")[4] - F.col("p")[3] <= little)).select(*LOCUS, "p", "f", F.col("p")[0].alias("a"), F.col("p")[5].alias("z"), size6.alias("n"))
    four = _paths(chains, 4).select(*LOCUS, F.col("p").alias("p4"), F.col("f").alias("f4"), F.col("p")[0].alias("a"), F.col("p")[3].alias("z"), (F.col("p")[2] - F.col("p")[1]).alias("n4"))
    both = six.join(four, [*LOCUS, "a", "z"]).where((F.abs(F.col("n") - F.col("n4")) <= apart) & (F.least("f", "f4") / F.greatest("f", "f4") < ratio))
    return both.select(*LOCUS, F.when(F.col("f") < F.col("f4"), F.col("p")).otherwise(F.col("p4")).alias("fragment")).distinct()


def fork_errors(chains: DataFrame, apart: int = 20, ratio: float = 0.05) -> DataFrame:
    """(locus, fragment): of two paths over one exon between a fork and a merge, with exon
    lengths at most ``apart`` different, the one with under ``ratio`` of the other's reads."""
    e = extend(chains).select(*LOCUS, F.explode(chain.windows(F.col("ext"), 2)).alias("p")).select(*LOCUS, F.col("p")[0].alias("u"), F.col("p")[1].alias("v")).distinct()
    d = degrees(e)
    four = _paths(chains, 4).withColumns({"a": F.col("p")[0], "z": F.col("p")[3], "n": F.col("p")[2] - F.col("p")[1]})
    four = four.join(d.where("out_degree > 1").select(*LOCUS, F.col("site").alias("a")), [*LOCUS, "a"], "left_semi").join(d.where("in_degree > 1").select(*LOCUS, F.col("site").alias("z")), [*LOCUS, "z"], "left_semi")
    other = four.select(*LOCUS, "a", "z", F.col("p").alias("p2"), F.col("f").alias("f2"), F.col("n").alias("n2"))
    both = four.join(other, [*LOCUS, "a", "z"]).where((F.col("p") != F.col("p2")) & (F.col("f") / F.col("f2") < ratio) & (F.abs(F.col("n") - F.col("n2")) <= apart))
    return both.select(*LOCUS, F.col("p").alias("fragment")).distinct()


def fork_pairs(chains: DataFrame) -> DataFrame:
    """(locus, p4, f4, known4, n4, p6, f6, known6, n6, all_known): paths of four and of six
    extended sites between one fork and one merge, with their reads, lengths and whether a
    known chain has them. chains has known where there is a reference."""
    known = F.col("known") if "known" in chains.columns else F.lit(False)
    ext = extend(chains.withColumn("known", F.coalesce(known, F.lit(False))))
    d = degrees(ext.select(*LOCUS, F.explode(chain.windows(F.col("ext"), 2)).alias("p")).select(*LOCUS, F.col("p")[0].alias("u"), F.col("p")[1].alias("v")).distinct())
    forks, merges = d.where("out_degree > 1").select(*LOCUS, F.col("site").alias("a")), d.where("in_degree > 1").select(*LOCUS, F.col("site").alias("z"))

    def paths(k: int) -> DataFrame:
        p = ext.select(*LOCUS, "frequency", "known", F.explode(chain.windows(F.col("ext"), k)).alias("p")).groupBy(*LOCUS, "p").agg(F.sum("frequency").alias("f"), F.bool_or("known").alias("known"))
        p = p.withColumns({"a": F.col("p")[0], "z": F.col("p")[k - 1], "n": chain.total(F.transform(chain.pairs(F.col("p")), lambda e: e["e"] - e["s"]))})
        return p.join(forks, [*LOCUS, "a"], "left_semi").join(merges, [*LOCUS, "z"], "left_semi")

    four, six = (paths(k).withColumnsRenamed({c: f"{c}{k}" for c in ("p", "f", "known", "n")}) for k in (4, 6))
    w = Window.partitionBy(*LOCUS, "a", "z")
    return four.join(six, [*LOCUS, "a", "z"]).withColumn("all_known", F.bool_and(F.col("known4") & F.col("known6")).over(w)).drop("a", "z")


def _rarer(pairs: DataFrame, apart: int, ratio: float, guarded: Column) -> DataFrame:
    """The inner sites of the rarer path of each pair."""
    low4 = F.col("f4") < F.col("f6")
    hit = (F.abs(F.col("n4") - F.col("n6")) <= apart) & (F.least("f4", "f6") / F.greatest("f4", "f6") < ratio) & guarded
    return pairs.where(hit).select(*LOCUS, F.when(low4, F.slice("p4", 2, 2)).otherwise(F.slice("p6", 2, 4)).alias("fragment")).distinct()


def exon_jump_errors(pairs: DataFrame, apart: int = 20, ratio: float = 0.05) -> DataFrame:
    """(locus, fragment): of two fork_pairs paths, with exon lengths at most ``apart`` different,
    the inner sites of the one with under ``ratio`` of the other's reads. The other is known,
    or neither is; ends that only known paths join are left alone."""
    better = F.when(F.col("f4") < F.col("f6"), F.col("known6")).otherwise(F.col("known4"))
    return _rarer(pairs, apart, ratio, (better | ~(F.col("known4") | F.col("known6"))) & ~F.col("all_known"))


def fake_exon_errors(pairs: DataFrame, apart: int = 50, ratio: float = 0.2) -> DataFrame:
    """As exon_jump_errors, where just the path with more reads is known."""
    better = F.when(F.col("f4") < F.col("f6"), F.col("known6")).otherwise(F.col("known4"))
    return _rarer(pairs, apart, ratio, better & (F.col("known4") != F.col("known6")))


def drop_fragments_of(chains: DataFrame, bad: DataFrame) -> DataFrame:
    """Chains whose extended sites hold none of the locus' fragments (locus, fragment), as sites in a row."""
    ext = extend(chains)
    parts = reduce(DataFrame.unionByName, [ext.select(*KEY, "Group", F.explode(chain.windows(F.col("ext"), k)).alias("fragment")) for k in (2, 4, 6)])
    gone = parts.join(bad, [*LOCUS, "fragment"], "left_semi").select(*KEY).distinct()
    return chains.join(gone, KEY, "left_anti")


def rescue_known(raw: DataFrame, current: DataFrame, reference: DataFrame) -> DataFrame:
    """current, with the raw chains that the reference has and it lacks."""
    back = raw.join(reference.select(*KEY).distinct(), KEY, "left_semi").join(current.select(*KEY), KEY, "left_anti")
    return current.unionByName(back, allowMissingColumns=True)


def merge_samples(by_sample: DataFrame) -> DataFrame:
    """Chains over all samples: reads, samples that have them, outermost ends."""
    return by_sample.groupBy(*KEY).agg(F.sum("frequency").alias("frequency"), F.count_distinct("sample").alias("samples"), F.min("lo").alias("lo"), F.max("hi").alias("hi"))


def rescue_samples(kept: DataFrame, raw: DataFrame, model: DataFrame) -> DataFrame:
    """Rows of samples for the model's chains: kept rows first, raw ones for pairs that kept lacks."""
    raw = raw.join(model.select(*KEY).distinct(), KEY, "left_semi").join(kept.select(*KEY, "sample"), [*KEY, "sample"], "left_anti")
    return kept.join(model.select(*KEY).distinct(), KEY, "left_semi").unionByName(raw)


def categories(chains: DataFrame, reference: DataFrame) -> DataFrame:
    """Adds category by the reference chains of the locus: FSM has an equal one, NIC only
    their sites, NNC another site. Both tables have Group; repeated reference rows count once. A
    chain without sites has no new one, so is NIC; without a reference all others are NNC."""
    same = reference.select(*LOCUS, "SSC", F.lit(True).alias("_same")).distinct()
    sites = reference.select(*LOCUS, F.explode(chain.sites(F.col("SSC"))).alias("site"), F.lit(True).alias("_known")).distinct()
    # chains with a site that the reference lacks; sites travel one by one, never a locus at once
    used = chains.select(*LOCUS, "SSC", F.explode(F.array_distinct(chain.sites(F.col("SSC")))).alias("site"))
    new = used.join(sites, [*LOCUS, "site"], "left_anti").select(*LOCUS, "SSC", F.lit(True).alias("_new")).distinct()
    out = chains.join(same, [*LOCUS, "SSC"], "left").join(new, [*LOCUS, "SSC"], "left")
    return out.withColumn("category", F.when(F.col("_same"), "FSM").when(F.col("_new"), "NNC").otherwise("NIC")).select(*chains.columns, "category")


def sub_chain_sources(chains: DataFrame) -> DataFrame:
    """(locus, SSC, source, source_frequency): longer chains of a locus that hold a chain."""
    a = chains.select(*LOCUS, "SSC", chain.sites(F.col("SSC")).alias("q"))
    b = chains.select(*LOCUS, F.col("SSC").alias("source"), F.col("frequency").alias("source_frequency"), chain.sites(F.col("SSC")).alias("t"))
    # sharing their first site is needed, so it is a key of the join
    a = a.withColumn("site", F.element_at("q", 1))
    b = b.withColumn("site", F.explode("t"))
    return a.join(b, [*LOCUS, "site"]).where(chain.is_sub_chain(F.col("q"), F.col("t"))).select(*LOCUS, "SSC", "source", "source_frequency").distinct()


def truncation(chains: DataFrame, source_share: float = 0.5, locus_share: float = 0.5, tss_score: str | None = None, tss_rescue: float = 0.1) -> DataFrame:
    """Adds truncation: "no" without a source, or with the given share both of the reads of
    chain and sources and of the locus; else "yes". A chain whose ``tss_score`` column is
    ``tss_rescue`` or more starts by itself and has no source; what is no number counts as 0."""
    own = chain.sites(F.col("SSC"))
    # parts of a chain that begin at an exon end: each has this chain as a source
    counts = F.sequence(F.lit(1), F.floor(F.size(own) / 2).cast("int") - 1)
    inner = F.flatten(F.transform(counts, lambda n: F.transform(F.sequence(F.lit(0), F.floor(F.size(own) / 2).cast("int") - n), lambda i: F.slice(own, 2 * i + 1, 2 * n))))
    parts = chains.where(F.size(own) >= 4).select(*LOCUS, "frequency", F.explode(F.array_distinct(inner)).alias("_sites"))
    s = parts.groupBy(*LOCUS, "_sites").agg(F.sum("frequency").alias("_source"))
    out = chains.withColumns({"_all": F.sum("frequency").over(Window.partitionBy(*LOCUS)), "_sites": own}).join(s, [*LOCUS, "_sites"], "left")
    strong = (F.col("frequency") / (F.col("frequency") + F.col("_source")) >= source_share) & (F.col("frequency") / F.col("_all") >= locus_share)
    own = F.lit(False)
    if tss_score:
        score = F.col(tss_score).cast("string").try_cast("double")
        own = F.coalesce(~F.isnan(score) & (score >= tss_rescue), F.lit(False))
    return out.withColumn("truncation", F.when(F.col("_source").isNull() | strong | own, "no").otherwise("yes")).select(*chains.columns, "truncation")


def drop_truncated(chains: DataFrame, reference: DataFrame | None = None) -> DataFrame:
    """Chains that are not called truncated, and those that the reference has (FSM), however they are called.
    A chain without a call goes, unless the reference has it."""
    if reference is None:
        return chains.where("truncation = 'no'")
    known = chains.join(reference.select(*KEY).distinct(), KEY, "left_semi").where("truncation is null or truncation <> 'no'")
    return chains.where("truncation = 'no'").unionByName(known)


def attach_categories(table: DataFrame, classified: DataFrame) -> DataFrame:
    """table with the category that its chain has among the classified ones (the smallest, if several loci
    give it some), null where it is none of them. A category that is there already is replaced."""
    of = classified.groupBy(*KEY).agg(F.min("category").alias("category"))
    return table.drop("category").join(of, KEY, "left")


def loci_with_data(chains: DataFrame, source: str = "source", reference: str = "ref") -> DataFrame:
    """Chains of the loci that do not consist of reference chains alone; a null source counts as data."""
    good = chains.groupBy(*LOCUS).agg(F.bool_or(F.coalesce(F.col(source) != reference, F.lit(True))).alias("_data")).where("_data")
    return chains.join(good.select(*LOCUS), LOCUS, "left_semi")


def with_single_exons(spliced: DataFrame, single: DataFrame, missing: dict[str, object] | None = None) -> DataFrame:
    """Spliced chains and the single-exon rows that were routed past the graph filters, in one table.

    Single-exon rows have neither chain nor locus: SSC and Group are null. Columns that one side lacks
    are null there, but for those in ``missing``, whose value single-exon rows get. No single-exon
    rows leave the chains as they are.
    """
    own = {c: F.lit(v) for c, v in (missing or {}).items() if c not in single.columns}
    rows = single.withColumns({**own, "SSC": F.lit(None).cast("string"), "Group": F.lit(None).cast("bigint")})
    return spliced.unionByName(rows, allowMissingColumns=True)
