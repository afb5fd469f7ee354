"""Transcripts of a catalogue named after an annotation: ids, genes and unique suffixes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from isoloom.functions import chain
from isoloom.operators.chains import KEY, LOCUS, loci
from isoloom.operators.quantify import terminal_flags
from isoloom.operators.remap import remap_novel_genes
from isoloom.stages import Staged, numbered

ENDS = [*KEY, "TrStart", "TrEnd"]
#: What ids that would be too long are called.
FUSED_GENE, FUSED_NOVEL = "FusionGene_", "NovelGeneCluster_Fusion_"


def _digest(ids: Column) -> Column:
    return F.substring(F.sha1(F.array_join(F.array_sort(ids), "\n").cast("binary")), 1, 12)


def joined_transcripts(ids: Column, budget: int = 200) -> Column:
    """Sorted ids joined by "_". Beyond ``budget`` bytes: the first one, of which at most 100 bytes of
    whole characters, how many more there are, and a digest of all."""
    ids = F.array_sort(ids)
    whole, first = F.array_join(ids, "_"), F.element_at(ids, 1)
    fits = F.filter(F.sequence(F.lit(0), F.lit(100)), lambda k: F.octet_length(F.substr(first, F.lit(1), k)) <= 100)
    short = F.concat(F.substr(first, F.lit(1), F.array_max(fits)), F.lit("_and_"), (F.size(ids) - 1).cast("string"), F.lit("_more_"), _digest(ids))
    return F.when(F.octet_length(whole) <= budget, whole).otherwise(short)


def joined_genes(ids: Column, budget: int = 200) -> Column:
    """Sorted ids or names joined by "-", or an alias by their digest that still says whether any is novel."""
    whole = F.array_join(F.array_sort(ids), "-")
    prefix = F.when(F.contains(whole, F.lit("NovelGene")), FUSED_NOVEL).otherwise(FUSED_GENE)
    return F.when(F.octet_length(whole) <= budget, whole).otherwise(F.concat(prefix, _digest(ids)))


def _sites() -> Column:
    return F.array_distinct(F.concat(F.array(F.col("TrStart").cast("bigint"), F.col("TrEnd").cast("bigint")), chain.sites(F.col("SSC"))))


def unique_ids(named: DataFrame) -> DataFrame:
    """TrID made unique: of the rows of one id the second by place, as text, gets ``_2`` behind it, and so on.
    Where that is another row's id already, uniqueTr follows it."""
    place = F.concat("Chr", "Strand", F.lit(":"), F.concat_ws("-", "TrStart", "SSC", "TrEnd"))
    n = F.row_number().over(Window.partitionBy("TrID").orderBy(place))
    later = named.withColumn("n", n).withColumn("base", F.col("TrID")).withColumn("TrID", F.when(F.col("n") > 1, F.concat_ws("_", "base", "n")).otherwise(F.col("base")))
    twice = F.count("*").over(Window.partitionBy("TrID")) > 1
    return later.withColumn("TrID", F.when(twice & (F.col("n") > 1), F.concat_ws("_", "TrID", "uniqueTr")).otherwise(F.col("TrID"))).drop("n", "base")


def annotate(transcripts: DataFrame, reference: DataFrame | None = None, tolerance: int = 50, least: int = 2, budget: int = 200, remap: bool = True) -> DataFrame:
    """One row for each transcript (chain and ends) with uniqueTr, Group, TrID, GeneID, GeneName and route.

    transcripts have Chr, Strand, SSC, TrStart, TrEnd and frequency; of repeated ones the smallest
    frequency stays. reference has TrID, GeneID, GeneName and the same places. uniqueTr is Tr and
    a number from 0 by contig, strand, chain and ends; Group the locus.

    - route "reference": the annotation has the chain. The ids of its transcripts with both
      ends within ``tolerance`` are joined, and their genes; where there are none, those of all,
      with AlterTss, AlterTes or AlterTssTes for how the nearest ends differ (ties: smaller).
    - route "gene": another transcript of the locus is of the reference, and the gene of such that shares
      most sites and ends with this one, ``least`` at the least (ties: the smaller id), gives its
      name, {gene}_Novel{uniqueTr}.
    - route "novel": NovelGene{Group} and NovelGene{Group}_Novel{uniqueTr}.

    Transcripts without chain or ends are left out; an empty table stays empty; without a
    reference all are novel. ``remap`` then brings novel genes under reference genes that share
    sites (``remap_novel_genes``). Joined ids are at most ``budget`` bytes or aliases.
    """
    staged = Staged(transcripts.sparkSession, "annotate")
    t = transcripts.where(" and ".join(f"{c} is not null" for c in ENDS)).groupBy(*ENDS).agg(F.min("frequency").alias("frequency"))
    t = numbered(t, ENDS, "n", staged).select("*", F.concat(F.lit("Tr"), F.col("n").cast("string")).alias("uniqueTr")).drop("n")
    t = staged.write(loci(t), "placed")
    gid = F.concat(F.lit("NovelGene"), F.col("Group").cast("string"))
    novel = {"TrID": F.concat(gid, F.lit("_Novel"), "uniqueTr"), "GeneID": gid, "GeneName": gid, "route": F.lit("novel")}
    if reference is None:
        return unique_ids(t.withColumns(novel))
    r = reference.select(*KEY, "TrID", "GeneID", F.coalesce("GeneName", "GeneID").alias("GeneName"), F.col("TrStart").alias("s"), F.col("TrEnd").alias("e"))
    near = (F.abs(F.col("TrStart") - F.col("s")) <= tolerance) & (F.abs(F.col("TrEnd") - F.col("e")) <= tolerance)
    row = F.struct("TrID", "GeneID", "GeneName")
    closest = lambda own, ref: F.min(F.struct(F.abs(F.col(ref) - F.col(own)).alias("d"), F.col(ref).alias("x")))["x"]
    known = t.join(r, KEY).groupBy(*t.columns).agg(F.collect_set(F.when(near, row)).alias("near"), F.collect_set(row).alias("any"), closest("TrStart", "s").alias("TrStart_ref"), closest("TrEnd", "e").alias("TrEnd_ref"))
    hit = F.size("near") > 0
    known = staged.write(terminal_flags(known, tolerance).select(*t.columns, F.when(hit, F.col("near")).otherwise(F.col("any")).alias("of"), F.when(hit, "").otherwise(F.col("flag")).alias("flag")), "known")
    ids = lambda c: F.array_distinct(F.transform("of", lambda x: x[c]))
    tr = F.concat_ws("_", joined_transcripts(ids("TrID"), budget), F.nullif(F.col("flag"), F.lit("")))
    by_reference = known.select(*t.columns, tr.alias("TrID"), joined_genes(ids("GeneID"), budget).alias("GeneID"), joined_genes(ids("GeneName"), budget).alias("GeneName"), F.lit("reference").alias("route"))
    # genes of a locus by their sites; names go along with the ids
    genes = known.select(*LOCUS, F.explode("of").alias("g"), _sites().alias("sites")).select(*LOCUS, "g.GeneID", "g.GeneName", F.explode("sites").alias("site")).distinct()
    rest = t.join(known.select("uniqueTr"), "uniqueTr", "left_anti")
    shared = rest.select(*LOCUS, "uniqueTr", F.explode(_sites()).alias("site")).join(genes, [*LOCUS, "site"]).groupBy("uniqueTr", "GeneID", "GeneName").agg(F.count("*").alias("n")).where(F.col("n") >= least)
    best = shared.groupBy("uniqueTr").agg(F.min(F.struct(-F.col("n"), "GeneID", "GeneName")).alias("b")).select("uniqueTr", F.col("b.GeneID").alias("g"), F.col("b.GeneName").alias("name"))
    found = F.col("g").isNotNull()
    by_gene = {"TrID": F.when(found, F.concat("g", F.lit("_Novel"), "uniqueTr")).otherwise(novel["TrID"]), "GeneID": F.coalesce("g", gid), "GeneName": F.coalesce("name", gid), "route": F.when(found, "gene").otherwise("novel")}
    others = rest.join(best, "uniqueTr", "left").withColumns(by_gene)
    out = unique_ids(by_reference.unionByName(others.select(*by_reference.columns)))
    return remap_novel_genes(out, reference.withColumn("GeneName", F.coalesce("GeneName", "GeneID"))) if remap else out
