"""Transcript filters by evidence, consensus sites, start shifts, reference collapse and sequences."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from isoloom.functions import chain
from isoloom.operators.chains import LOCUS
from isoloom.operators.quantify import terminal_flags


def _no_tails(rescue_known: bool) -> tuple[Column, Column]:
    """(measured without any tail, of those the known chains that are spared)."""
    none = (F.col("polyA_frac") == 0) & (F.coalesce("polyA_valid_reads", F.lit(0)) == 0)
    none = F.coalesce(none, F.lit(False))
    known = F.coalesce(F.col("category") == "FSM", F.lit(False)) if rescue_known else F.lit(False)
    return none, none & known


def soft_filter(transcripts: DataFrame, start: float, polya: float, rescue_known: bool = True) -> DataFrame:
    """Drops transcripts with two signs against them: decay or truncation with a weak
    start or few tails, or both of these.

    Reads tss_50 (null: no peak, which is weak), polyA_frac (null: not measured, which
    is no sign), polyA_valid_reads, nmd, truncation and category.
    """
    none, spared = _no_tails(rescue_known)
    few = F.coalesce(F.when(F.col("polyA_frac") > 0, F.col("polyA_frac") < polya).when(none, ~spared), F.lit(False))
    weak = F.coalesce(F.col("tss_50") < start, F.lit(True))
    doubted = F.coalesce(F.col("nmd") == "NMD", F.lit(False)) | F.coalesce(F.col("truncation") == "yes", F.lit(False))
    return transcripts.where(~((doubted & (weak | few)) | (weak & few)))


def hard_filter(transcripts: DataFrame, start: float, polya: float, rescue_known: bool = True) -> DataFrame:
    """Transcripts with a start (tss_15) over its limit whose tails are over theirs, not
    measured, or absent from a known chain."""
    _, spared = _no_tails(rescue_known)
    tails = F.col("polyA_frac").isNull() | (F.col("polyA_frac") > polya) | spared
    return transcripts.where((F.col("tss_15") > start) & tails)


def shift_starts(transcripts: DataFrame, least: float = 0.02) -> DataFrame:
    """Moves the 5' end to its peak (tss_offset, tss_height) where that is higher than ``least``."""
    moved = F.coalesce(F.col("tss_height") > least, F.lit(False))
    plus = F.col("Strand") == "+"
    return transcripts.withColumns({
        "TrStart": F.when(moved & plus, F.col("TrStart") + F.col("tss_offset") - 1).otherwise(F.col("TrStart")),
        "TrEnd": F.when(moved & ~plus, F.col("TrEnd") - F.col("tss_offset") + 1).otherwise(F.col("TrEnd")),
    })


def consensus_sites(chains: DataFrame, reach: int = 20) -> DataFrame:
    """(locus, site, center, n, total): sites of a locus in greedy clusters.

    Chains are taken by reads, then sites, both descending, then by name; a site joins
    the oldest center within ``reach`` or becomes one. A site is placed when first met,
    so one row a distinct site is enough; and a gap over ``reach`` parts clusters, so
    each stretch without one is placed on its own.
    """
    s = chain.sites(F.col("SSC"))
    seen = chains.select(*LOCUS, "SSC", "frequency", F.size(s).alias("size"), F.posexplode(s).alias("pos", "site"))
    met = F.min(F.struct((-F.col("frequency")).alias("f"), (-F.col("size")).alias("s"), "SSC", "pos"))
    sites = seen.groupBy(*LOCUS, "site").agg(F.count("*").alias("n"), F.sum("frequency").alias("total"), met.alias("met"))
    order = Window.partitionBy(*LOCUS).orderBy("site")
    apart = F.coalesce((F.col("site") - F.lag("site").over(order) > reach).cast("int"), F.lit(0))
    runs = sites.withColumn("_new", apart).withColumn("run", F.sum("_new").over(order))
    turn = F.row_number().over(Window.partitionBy(*LOCUS, "run").orderBy("met"))
    runs = runs.select(*LOCUS, "run", "site", "n", "total", turn.alias("turn"))

    def place(run: pd.DataFrame) -> pd.DataFrame:
        run = run.sort_values("turn")
        centers: list[int] = []
        at = []
        for site in run["site"]:
            c = next((c for c in centers if abs(site - c) <= reach), None)
            if c is None:
                centers.append(c := site)
            at.append(c)
        return run.assign(center=at)[[*LOCUS, "site", "center", "n", "total"]]

    types = {f.name: f.dataType.simpleString() for f in runs.schema}
    schema = ", ".join(f"`{c}` {types[c]}" for c in LOCUS) + ", site bigint, center bigint, n bigint, total bigint"
    return runs.groupBy(*LOCUS, "run").applyInPandas(place, schema)


def off_consensus(chains: DataFrame, reach: int = 20, ratio: float = 0.1) -> DataFrame:
    """(locus, site): sites with under ``ratio`` of the reads of their cluster's best,
    in clusters that are not made of single reads alone."""
    w = Window.partitionBy(*LOCUS, "center")
    c = consensus_sites(chains, reach).withColumns({"_n": F.sum("n").over(w), "_all": F.sum("total").over(w), "_top": F.max("total").over(w)})
    return c.where((F.col("_n") != F.col("_all")) & (F.col("total") / F.col("_top") < ratio)).select(*LOCUS, "site")


def one_per_transcript(rows: DataFrame, tolerance: int = 50, budget: int = 200) -> DataFrame:
    """One row a uniqueTr from rows of its reference matches (TrID, TrStart_ref, TrEnd_ref).

    The ids of references with both ends within ``tolerance`` are joined; where there
    are none, all ids are, with the flag of the nearest ends (ties: the smaller) behind.
    """
    near = (F.abs(F.col("TrStart") - F.col("TrStart_ref")) <= tolerance) & (F.abs(F.col("TrEnd") - F.col("TrEnd_ref")) <= tolerance)
    closest = lambda end: F.min(F.struct(F.abs(F.col(f"{end}_ref") - F.col(end)).alias("d"), F.col(f"{end}_ref").alias("x")))["x"]
    g = rows.groupBy("uniqueTr", "Chr", "Strand", "TrStart", "TrEnd").agg(
        F.collect_set(F.when(near, F.col("TrID"))).alias("_near"), F.collect_set("TrID").alias("_any"), closest("TrStart").alias("_s"), closest("TrEnd").alias("_e")
    )
    hit = F.size("_near") > 0
    g = g.withColumns({"TrStart_ref": F.when(hit, F.col("TrStart")).otherwise(F.col("_s")), "TrEnd_ref": F.when(hit, F.col("TrEnd")).otherwise(F.col("_e"))})
    joined = chain.bounded_id(F.when(hit, F.col("_near")).otherwise(F.col("_any")), "Fusion_", budget=budget)
    out = terminal_flags(g, tolerance)
    return out.select("uniqueTr", "Chr", "Strand", "TrStart", "TrEnd", F.concat_ws("_", joined, F.nullif(F.col("flag"), F.lit(""))).alias("TrID"))


def genome_bins(contigs: DataFrame, width: int = 100_000) -> DataFrame:
    """(Chr, bin, piece): contigs (contig, seq) in pieces, so that no later step moves a whole one."""
    # as bytes, since a slice of a string is found by counting its characters
    raw = contigs.select(F.col("contig").alias("Chr"), F.col("seq").cast("binary").alias("seq")).where("length(seq) > 0")
    bins = raw.select("Chr", "seq", F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.length("seq") - 1) / width))).alias("bin"))
    return bins.select("Chr", "bin", F.expr(f"cast(substring(seq, cast(bin * {width} + 1 as int), {width}) as string)").alias("piece"))


def transcript_sequences(transcripts: DataFrame, bins: DataFrame, width: int = 100_000) -> DataFrame:
    """(TrID, seq, seq_len): exons in a row, the minus strand reversed and complemented.
    What lies behind a contig's end is empty; transcripts on contigs without sequence are left out."""
    # no bases of the first bin: these keep a transcript of which no exon lies within its contig
    none = F.array(F.struct(F.lit(1).cast("bigint").alias("s"), F.lit(0).cast("bigint").alias("e")))
    ex = transcripts.select("TrID", "Chr", "Strand", F.explode(F.concat(none, chain.exons(F.col("TrStart"), chain.sites(F.col("SSC")), F.col("TrEnd")))).alias("x"))
    ex = ex.select("TrID", "Chr", "Strand", (F.col("x.s") - 1).alias("a"), F.col("x.e").alias("b"))
    ex = ex.withColumn("bin", F.explode(F.sequence(F.floor(F.col("a") / width), F.floor((F.col("b") - 1) / width))))
    lo = F.greatest(F.col("a") - F.col("bin") * width, F.lit(0))
    hi = F.least(F.col("b") - F.col("bin") * width, F.lit(width))
    cut = ex.join(bins, ["Chr", "bin"]).select("TrID", "Strand", "a", "bin", F.substr("piece", (lo + 1).cast("int"), (hi - lo).cast("int")).alias("part"))
    g = cut.groupBy("TrID", "Strand").agg(F.array_sort(F.collect_list(F.struct("a", "bin", "part"))).alias("x"))
    seq = F.array_join(F.transform("x", lambda x: x["part"]), "")
    g = g.select("TrID", F.when(F.col("Strand") == "-", chain.reverse_complement(seq)).otherwise(seq).alias("seq"))
    return g.withColumn("seq_len", F.length("seq"))


def fasta_records(sequences: DataFrame, line: int = 80) -> DataFrame:
    """(value): a FASTA record each of (TrID, seq), in lines of ``line`` letters; ready for write.text."""
    wrapped = F.regexp_replace("seq", f"(.{{{line}}})(?=.)", "$1\n")
    return sequences.select(F.concat(F.lit(">"), "TrID", F.lit("\n"), wrapped).alias("value"))
