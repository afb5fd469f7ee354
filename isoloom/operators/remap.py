"""Chains and novel genes led back to the reference."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from isoloom.functions import chain
from isoloom.operators.chains import LOCUS

#: Prefixes of fused gene ids, and of those that would be too long.
FUSED, LONG_FUSED = "NovelGeneCluster_", "NovelGeneCluster_LongFusion_"


def _nearest(chains: DataFrame, reference: DataFrame) -> DataFrame:
    """Adds s, the sites of a chain, m, the nearest reference site of the locus to each
    (ties: the smaller), and off, the pairs (s, m) that differ."""
    known = reference.select(*LOCUS, F.explode(chain.sites(F.col("SSC"))).alias("site")).groupBy(*LOCUS).agg(F.collect_set("site").alias("_known"))
    near = lambda x: F.array_min(F.transform("_known", lambda r: F.struct(F.abs(r - x).alias("d"), r.alias("r"))))["r"]
    out = chains.withColumn("s", chain.sites(F.col("SSC"))).join(known, LOCUS).withColumn("m", F.transform("s", near))
    return out.withColumn("off", F.filter(F.zip_with("s", "m", lambda x, y: F.struct(x.alias("s"), y.alias("m"))), lambda p: p["s"] != p["m"])).drop("_known")


def little_exon_paths(reference: DataFrame, little: int = 30) -> DataFrame:
    """(locus, path): site before, start, end and site behind of reference exons under ``little``."""
    p = reference.select(*LOCUS, F.explode(chain.windows(chain.sites(F.col("SSC")), 4, 2)).alias("path"))
    return p.where(F.col("path")[2] - F.col("path")[1] < little).distinct()


def add_little_exons(near: DataFrame, paths: DataFrame) -> DataFrame:
    """(locus, SSC, to): chains of _nearest that jump a little exon, with it put in. Their
    sites but for the two around the jump are known; those two lie within the path. Of
    several paths the smallest is taken."""
    jumps = near.where("size(off) <= 2").withColumn("i", F.explode(F.sequence(F.lit(1), F.greatest(F.size("m") - 1, F.lit(1))))).where("i < size(m)")
    jumps = jumps.withColumns({"a": F.expr("m[i - 1]"), "z": F.expr("m[i]"), "moved": F.expr("int(s[i - 1] <> m[i - 1]) + int(s[i] <> m[i])")}).where("moved = size(off)")
    hit = jumps.join(paths.withColumns({"a": F.col("path")[0], "z": F.col("path")[3]}), [*LOCUS, "a", "z"])
    hit = hit.where(F.forall("off", lambda p: p["s"].between(F.col("a"), F.col("z"))))
    best = hit.groupBy(*LOCUS, "SSC").agg(F.min(F.struct("path", "i", "m")).alias("x"))
    to = F.expr("concat(slice(x.m, 1, x.i - 1), x.path, slice(x.m, x.i + 2, size(x.m)))")
    return best.select(*LOCUS, "SSC", to.alias("to"))


def pull_sites(near: DataFrame, shift: int = 20, share: float = 0.25, excursion: int = 20, tail: int = 50) -> DataFrame:
    """(locus, SSC, to): chains of _nearest with displaced sites moved to the reference.

    One site under ``shift`` away, in a chain with less than ``share`` of the locus'
    reads; else two sites in a row that moved the same way, by amounts less than
    ``excursion`` apart; else a 3' tail of sites that all fall on one reference site,
    in such a rare chain whose last site is within ``tail`` of the mean read end.
    """
    d = lambda i: F.col("off")[i]["s"] - F.col("off")[i]["m"]
    n, rare = F.size("off"), F.col("frequency") / F.col("reads") < share
    one = (n == 1) & (F.abs(d(0)) < shift)
    in_row = F.array_position("s", F.col("off")[1]["s"]) - F.array_position("s", F.col("off")[0]["s"]) == 1
    two = (n == 2) & in_row
    twice = F.array_distinct(F.filter("m", lambda x: F.size(F.filter("m", lambda y: y == x)) > 1))
    plus = F.col("Strand") == "+"
    first = F.array_position("m", F.col("twice")[0]).cast("int")
    last = (F.size("m") - F.array_position(F.reverse("m"), F.col("twice")[0]) + 1).cast("int")
    same = lambda part: F.size(F.array_distinct(part)) == 1
    behind = same(F.slice("m", first, F.size("m"))) & (F.abs(F.element_at("s", -1) - F.floor("mean_end")) < tail)
    before = same(F.slice("m", F.lit(1), last - 1)) & (F.abs(F.col("s")[0] - F.floor("mean_start")) < tail)
    cut = F.when(plus & behind, F.slice("m", F.lit(1), first)).when(~plus & before, F.slice("m", last, F.size("m")))
    to = (
        F.when(one, F.when(rare, F.col("m")))
        .when(two, F.when((d(0) * d(1) > 0) & (F.abs(d(0) - d(1)) < excursion), F.col("m")))
        .when((n >= 2) & (F.size("twice") == 1) & rare, cut)
    )
    return near.withColumn("twice", twice).select(*LOCUS, "SSC", to.alias("to")).where("to is not null")


def map_to_reference(chains: DataFrame, reference: DataFrame, little: int = 30, shift: int = 20, share: float = 0.25, excursion: int = 20, tail: int = 50) -> DataFrame:
    """Adds mapped_SSC: the chain, or what its correction makes of it where a reference
    chain of the locus has that as sites in a row.

    chains has frequency, category (NIC and NNC are corrected), mean_start and mean_end
    of the reads; reference has the locus and SSC. Little exons are put in for both
    categories; sites are pulled for NNC, in loci whose reference has no little exon.
    """
    ref = reference.select(*LOCUS, "SSC").distinct()
    reads = chains.withColumn("reads", F.sum("frequency").over(Window.partitionBy(*LOCUS)))
    near = _nearest(reads.where(F.col("category").isin("NIC", "NNC")), ref)
    paths = little_exon_paths(ref, little)
    pulled = pull_sites(near.where("category = 'NNC'").join(paths.select(*LOCUS).distinct(), LOCUS, "left_anti"), shift, share, excursion, tail)
    to = add_little_exons(near, paths).unionByName(pulled)
    whole = ref.select(*LOCUS, chain.sites(F.col("SSC")).alias("t")).withColumn("site", F.explode("t"))
    found = to.withColumn("site", F.col("to")[0]).join(whole, [*LOCUS, "site"]).where(chain.holds(F.col("t"), F.col("to")))
    found = found.select(*LOCUS, "SSC", chain.joined(F.col("to")).alias("mapped_SSC")).distinct()
    return chains.join(found, [*LOCUS, "SSC"], "left").withColumn("mapped_SSC", F.coalesce("mapped_SSC", "SSC"))


def merge_mapped(mapped: DataFrame) -> DataFrame:
    """Chains of map_to_reference under their new names: reads summed, ends outermost."""
    return mapped.groupBy(*LOCUS, F.col("mapped_SSC").alias("SSC")).agg(F.sum("frequency").alias("frequency"), F.min("lo").alias("lo"), F.max("hi").alias("hi"))


def novel_gene_matches(transcripts: DataFrame, reference: DataFrame, least: int = 2) -> DataFrame:
    """(GeneID, ids, names): reference genes of a novel gene, by id. They share ``least`` of
    its sites; all those whose sites it has all, or, without such, those that share most."""
    place = ["Chr", "Strand", "site"]
    q = transcripts.where(F.contains("GeneID", F.lit("NovelGene"))).select("GeneID", "Chr", "Strand", F.explode(chain.sites(F.col("SSC"))).alias("site")).distinct()
    r = reference.select(F.col("GeneID").alias("id"), F.col("GeneName").alias("name"), "Chr", "Strand", F.explode(chain.sites(F.col("SSC"))).alias("site")).distinct()
    sizes = r.groupBy("id", "name", "Chr", "Strand").agg(F.count("*").alias("size"))
    n = q.join(r, place).groupBy("GeneID", "id", "name", "Chr", "Strand").agg(F.count("*").alias("n")).where(F.col("n") >= least)
    w = Window.partitionBy("GeneID")
    n = n.join(sizes, ["id", "name", "Chr", "Strand"]).withColumn("full", F.col("n") == F.col("size"))
    n = n.withColumns({"any": F.bool_or("full").over(w), "most": F.max("n").over(w)}).where(F.when(F.col("any"), F.col("full")).otherwise(F.col("n") == F.col("most")))
    g = n.groupBy("GeneID").agg(F.array_sort(F.collect_set(F.struct("id", "name"))).alias("x"))
    return g.select("GeneID", F.col("x.id").alias("ids"), F.col("x.name").alias("names"))


def _fused(values: str) -> Column:
    return F.when(F.size(values) == 1, F.col(values)[0]).otherwise(F.concat(F.lit(FUSED), F.array_join(values, "_")))


def remap_novel_genes(transcripts: DataFrame, reference: DataFrame, least: int = 2, tx_bytes: int = 254, gene_bytes: int = 200) -> DataFrame:
    """Novel genes under the reference genes they match, their transcript ids rewritten.

    A transcript keeps what stands behind the first "_" of its id, or all of it where
    that is not unique in the gene. A gene whose id or name, or one of whose transcript
    ids, would be too long is numbered instead, by order of its former id; only such
    genes pass through one task, a row each. ids that stay too long are left to check_ids.
    """
    match = novel_gene_matches(transcripts, reference, least).select("GeneID", _fused("ids").alias("id"), _fused("names").alias("name"))
    t = transcripts.join(match, "GeneID", "left")
    end = F.expr("if(instr(TrID, '_') > 0, substring(TrID, instr(TrID, '_')), '')")
    t = t.withColumn("_end", end)
    alone = F.count("*").over(Window.partitionBy("GeneID", "_end")) == 1
    t = t.withColumn("_end", F.when(alone, F.col("_end")).otherwise(F.concat(F.lit("_"), "TrID")))
    sizes = t.where("id is not null").groupBy("GeneID").agg(F.max(F.octet_length("_end") + F.octet_length("id")).alias("tx"), F.max(F.greatest(F.octet_length("id"), F.octet_length("name"))).alias("gene"))
    long_ = sizes.where((F.col("tx") > tx_bytes) | (F.col("gene") > gene_bytes)).select("GeneID", F.concat(F.lit(LONG_FUSED), F.row_number().over(Window.orderBy("GeneID")).cast("string")).alias("alias"))
    t = t.join(long_, "GeneID", "left")
    gene, name = F.coalesce("alias", "id"), F.coalesce("alias", "name")
    out = {"TrID": F.coalesce(F.concat(gene, "_end"), "TrID"), "GeneName": F.coalesce(name, "GeneName"), "GeneID": F.coalesce(gene, "GeneID")}
    return t.withColumns(out).select(*transcripts.columns)
