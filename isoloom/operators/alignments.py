"""Alignment records to read rows, and the motifs of their junctions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from isoloom.functions import chain
from isoloom.stages import Staged

KEY = ["Chr", "Strand", "SSC"]


def strand(flag: Column, xs: Column, ts: Column) -> Column:
    """The transcript's strand: XS, or ts turned round for a reverse alignment, or the alignment's own.

    A null or empty XS counts as none, and so does a ts that is neither + nor -.
    """
    back = F.coalesce(flag.bitwiseAND(16) != 0, F.lit(False))
    told = F.when(ts.isin("+", "-"), F.when(back, F.translate(ts, "+-", "-+")).otherwise(ts))
    return F.coalesce(F.nullif(xs, F.lit("")), told, F.when(back, "-").otherwise("+"))


def to_reads(alignments: DataFrame, sample: str | None = None) -> DataFrame:
    """Read rows of alignments (read_id, flag, Chr, pos, cigar, seq, xs, ts, nm, pt); ``sample`` is carried along.

    Unmapped records and those without sequence or CIGAR are left out. A read's n-th
    alignment, by contig, position, CIGAR and flag, gets the suffix ``.m{n}``; repeated rows
    are alignments of their own. Identity is 1 - NM / (M and I bases), 1 without NM and 0
    without such bases; coverage is the sequence's share that is not clipped. A tail that is
    null or below 0 is 0, and has_tail says whether there was a tag. SSC is null without
    introns. An empty table gives an empty one. The alignments of one name are numbered in one
    task, so names must be those of reads, which have few.
    """
    given = alignments.where("coalesce(flag, 0) & 4 = 0 and seq <> '*' and seq <> '' and cigar <> '*' and cigar <> ''")
    a = given.withColumn("_p", chain.cigar(F.col("cigar")))
    at = lambda x: F.col("pos") + x
    ends = F.flatten(F.transform("_p.exons", lambda x: F.array(at(x["s"]), at(x["e"]) - 1)))
    inner = F.slice(ends, F.lit(2), F.size(ends) - 2)
    length = F.length("seq")
    identity = F.when(F.col("nm").isNull(), 1.0).when(F.col("_p.covered") > 0, 1 - F.col("nm") / F.col("_p.covered")).otherwise(0.0)
    by = ["read_id"] + [c for c in (sample,) if c]  # the name first, by which rows are sorted sooner than by samples
    placed = a.select(
        *reversed(by), "Chr", strand(F.col("flag"), F.col("xs"), F.col("ts")).alias("Strand"), "pos", "cigar", "flag",
        F.col("pos").alias("TrStart"), (F.col("pos") + F.col("_p.spanned") - 1).alias("TrEnd"),
        F.when(F.size("_p.exons") > 1, chain.joined(inner)).alias("SSC"),
        identity.alias("identity"), ((length - F.col("_p.clipped")) / length).alias("coverage"),
        F.greatest(F.coalesce("pt", F.lit(0)), F.lit(0)).cast("int").alias("polyA_len"), F.col("pt").isNotNull().alias("has_tail"),
    )
    w = Window.partitionBy(*by).orderBy("Chr", "pos", "cigar", "flag", "SSC", "identity", "polyA_len")
    return placed.withColumn("read_id", F.concat("read_id", F.lit(".m"), F.row_number().over(w).cast("string"))).drop("pos", "cigar", "flag")


def has_tails(reads: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """(has_polya) of a library: whether any alignment had a tail tag, be it 0. No rows: false, without ``by``."""
    return reads.groupBy(*by).agg(F.coalesce(F.max("has_tail"), F.lit(False)).alias("has_polya"))


def junction_counts(reads: DataFrame, bins: DataFrame, width: int = 100_000) -> DataFrame:
    """(count, chain, junction) of reads: the two bases at both ends of each intron, donor-acceptor
    pairs joined by commas in the transcript's direction; ``bins`` as genome_bins makes them.

    Each distinct intron is looked up once, whatever the number of its reads. A base outside
    the contig, or of a contig without sequence, is left out, so that such a motif is ``-``.
    Reads without introns count for no chain. Chains are counted once and written, since all
    that follows is made of them.
    """
    chains = reads.where("SSC is not null").groupBy(*KEY).agg(F.count("*").alias("count"))
    chains = Staged(reads.sparkSession, "junctions").write(chains, "chains")
    introns = chains.select(*KEY, F.posexplode(chain.introns(chain.sites(F.col("SSC")))).alias("i", "x")).select(*KEY, "i", F.col("x.s").alias("s"), F.col("x.e").alias("e"))
    # 0-based places of the first and the last two bases of an intron
    ends = introns.select("Chr", F.explode(F.array("s", F.col("e") - 3)).alias("at")).distinct()
    base = ends.select("Chr", "at", F.posexplode(F.array("at", F.col("at") + 1)).alias("k", "b")).withColumn("bin", F.floor(F.col("b") / width))
    found = base.join(bins, ["Chr", "bin"]).where("b >= 0").select("Chr", "at", "k", F.substr("piece", (F.col("b") - F.col("bin") * width + 1).cast("int"), F.lit(1)).alias("base"))
    two = found.groupBy("Chr", "at").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("k", "base"))), lambda x: x["base"]), "").alias("two"))
    at = lambda c: two.select("Chr", F.col("at").alias(c), F.col("two").alias(f"{c}_two"))
    read = introns.withColumns({"left": F.col("s"), "right": F.col("e") - 3}).join(at("left"), ["Chr", "left"], "left").join(at("right"), ["Chr", "right"], "left")
    left, right = F.coalesce("left_two", F.lit("")), F.coalesce("right_two", F.lit(""))
    back = F.col("Strand") == "-"
    motif = F.when(back, F.concat_ws("-", chain.reverse_complement(right), chain.reverse_complement(left))).otherwise(F.concat_ws("-", left, right))
    g = read.select(*KEY, F.when(back, -F.col("i")).otherwise(F.col("i")).alias("o"), motif.alias("motif")).groupBy(*KEY).agg(F.array_sort(F.collect_list(F.struct("o", "motif"))).alias("m"))
    return chains.join(g.select(*KEY, F.array_join(F.transform("m", lambda x: x["motif"]), ",").alias("junction")), KEY).select("count", *KEY, "junction")
