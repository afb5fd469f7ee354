"""Counts, matrices, names and checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from isoloom.functions import chain
from isoloom.operators.chains import KEY, LOCUS

ENDS = [*KEY, "TrStart", "TrEnd"]


def transcript_counts(reads: DataFrame, transcripts: DataFrame, n: str | None = None) -> DataFrame:
    """(sample, TrID, GeneID, count) of corrected reads that have a transcript's chain and both ends.
    ``n`` is the column that counts the reads of a row, where rows are not single reads.

    Reads of one chain go to the transcript whose ends they have; reads with other ends
    count for none. Transcripts that share all five keys each get the reads. Repeated
    transcript rows count once; no reads or no transcripts give no row. A transcript
    without TrID or GeneID raises when the result is computed.
    """
    named = F.when(F.col("TrID").isNotNull() & F.col("GeneID").isNotNull(), F.col("TrID")).otherwise(F.raise_error(F.lit("a transcript has no TrID or GeneID")))
    t = transcripts.select(*ENDS, named.alias("TrID"), "GeneID").distinct()
    found = reads.where("SSC is not null").groupBy("sample", *ENDS).agg((F.sum(n) if n else F.count("*")).alias("n"))
    return found.join(t, ENDS).groupBy("sample", "TrID", "GeneID").agg(F.sum("n").alias("count"))


class QuantificationError(RuntimeError):
    """Samples cannot be counted."""


def failed_samples(reads: DataFrame, samples: list[str]) -> DataFrame:
    """(sample_name, error_type, error_message) of the samples that cannot be counted: those without
    any spliced read. Samples are compared by name; none of them failing gives no row."""
    have = reads.where("SSC is not null").select("sample").distinct()
    asked = reads.sparkSession.createDataFrame([(s,) for s in sorted(set(samples))], "sample string")
    return asked.join(have, "sample", "left_anti").select(F.col("sample").alias("sample_name"), F.lit("NoReads").alias("error_type"), F.lit("the sample has no spliced reads").alias("error_message"))


def quantify(reads: DataFrame, transcripts: DataFrame, samples: list[str], partial: bool = False, failures: str | None = None, n: str | None = None) -> DataFrame:
    """transcript_counts of the samples asked for, in one job for all.

    A sample that cannot be counted would vanish from the matrices and from what counts are a
    share of, so it is an error; with ``partial`` the others are counted. Either way the failed
    ones are written to the folder ``failures``, tab-separated, if there are any.
    """
    bad = failed_samples(reads, samples).orderBy("sample_name").collect()  # a row a sample that was asked for
    if bad and failures:
        reads.sparkSession.createDataFrame(bad).coalesce(1).write.option("sep", "\t").option("header", "true").mode("overwrite").csv(failures)
    if bad and (not partial or len(bad) == len(set(samples))):
        raise QuantificationError(f"no spliced reads in {', '.join(r.sample_name for r in bad)}")
    return transcript_counts(reads.where(F.col("sample").isin(*samples)), transcripts, n)


def expressed(counts: DataFrame, libraries: int, least: int = 1) -> DataFrame:
    """Counts of transcripts that min(libraries, least) libraries have."""
    good = counts.where("count > 0").groupBy("TrID").agg(F.count_distinct("sample").alias("n")).where(F.col("n") >= min(libraries, least))
    return counts.join(good.select("TrID"), "TrID", "left_semi")


def cpm(counts: DataFrame) -> DataFrame:
    """Adds cpm: per million counts of the library, all its transcripts or genes counted; 0 in a library
    that counts nothing, null where the count is. A library's sum is one row, combined before the
    shuffle, so none is one task. Rows without sample are left out; an empty table stays empty."""
    sums = counts.groupBy("sample").agg(F.sum("count").alias("_sum"))
    return counts.join(sums, "sample").withColumn("cpm", F.when(F.col("_sum") == 0, F.col("count") * 0.0).otherwise(F.try_divide(F.col("count") * 1e6, F.col("_sum")))).select(*counts.columns, "cpm")


def gene_counts(counts: DataFrame) -> DataFrame:
    return counts.groupBy("sample", "GeneID").agg(F.sum("count").alias("count"))


def matrix(table: DataFrame, keys: list[str], samples: list[str], value: str) -> DataFrame:
    """Wide: a column for each sample, 0 where there is no row."""
    return table.groupBy(*keys).pivot("sample", samples).agg(F.sum(value)).na.fill(0)


def gene_model_map(genes: DataFrame, model: DataFrame, totals: DataFrame) -> DataFrame:
    """All genes with counts: whether and with how many transcripts the model has them, and how many there are."""
    m = model.groupBy("GeneID").agg(F.count("*").alias("n_model_transcripts"))
    t = totals.groupBy("GeneID").agg(F.count_distinct("TrID").alias("n_total_transcripts"))
    out = genes.select("GeneID").distinct().join(m, "GeneID", "full").join(t, "GeneID", "left")
    return out.select("GeneID", F.col("n_model_transcripts").isNotNull().alias("in_transcript_model"), F.coalesce("n_model_transcripts", F.lit(0)).alias("n_model_transcripts"), F.coalesce("n_total_transcripts", F.lit(0)).alias("n_total_transcripts"))


def novel_ids(chains: DataFrame) -> DataFrame:
    """GeneID NovelGene{g} and TrID NovelGene{g}_NovelTr{n}, n by chain and ends in the locus."""
    ends = [c for c in ("TrStart", "TrEnd") if c in chains.columns]
    n = F.row_number().over(Window.partitionBy(*LOCUS).orderBy("SSC", *ends))
    g = F.concat(F.lit("NovelGene"), F.col("Group").cast("string"))
    return chains.withColumns({"GeneID": g, "TrID": F.concat(g, F.lit("_NovelTr"), n.cast("string"))})


def query_genes(query: DataFrame, reference: DataFrame, least: int = 2) -> DataFrame:
    """(chain, GeneID, shared): the reference gene of the locus that shares most sites with a
    chain, ``least`` at the least; of ties the smaller id."""
    q = query.select(*LOCUS, "SSC", F.explode(F.array_distinct(chain.sites(F.col("SSC")))).alias("site"))
    r = reference.select(*LOCUS, "GeneID", F.explode(chain.sites(F.col("SSC"))).alias("site")).distinct()
    n = q.join(r, [*LOCUS, "site"]).groupBy(*LOCUS, "SSC", "GeneID").agg(F.count("*").alias("shared")).where(F.col("shared") >= least)
    w = Window.partitionBy(*LOCUS, "SSC").orderBy(F.desc("shared"), "GeneID")
    return n.withColumn("_r", F.row_number().over(w)).where("_r = 1").drop("_r")


def terminal_flags(transcripts: DataFrame, tolerance: int = 50) -> DataFrame:
    """Adds flag: AlterTss, AlterTes or AlterTssTes where ends are further than ``tolerance``
    from the reference's (TrStart_ref, TrEnd_ref), by strand; else an empty string."""
    lo, hi = F.abs(F.col("TrStart") - F.col("TrStart_ref")) > tolerance, F.abs(F.col("TrEnd") - F.col("TrEnd_ref")) > tolerance
    tss, tes = F.when(F.col("Strand") == "-", hi).otherwise(lo), F.when(F.col("Strand") == "-", lo).otherwise(hi)
    return transcripts.withColumn("flag", F.when(tss & tes, "AlterTssTes").when(tss, "AlterTss").when(tes, "AlterTes").otherwise(""))


def fuse_ids(rows: DataFrame, keys: list[str], column: str, prefix: str, budget: int = 200) -> DataFrame:
    """One row a key with its distinct ids joined, or an alias beyond ``budget`` bytes."""
    return rows.groupBy(*keys).agg(F.collect_set(column).alias("_ids")).withColumn(column, chain.bounded_id(F.col("_ids"), prefix, budget=budget)).drop("_ids")


def check_ids(transcripts: DataFrame, tx_bytes: int = 254, gene_bytes: int = 200) -> DataFrame:
    """(rule, n): ids that are too long, and ids that several rows have."""
    long_tx = transcripts.where(F.octet_length("TrID") > tx_bytes).agg(F.lit("tx_length").alias("rule"), F.count("*").alias("n"))
    long_gene = transcripts.where(F.octet_length("GeneID") > gene_bytes).agg(F.lit("gene_length").alias("rule"), F.count("*").alias("n"))
    twice = transcripts.groupBy("TrID").count().where("count > 1").agg(F.lit("tx_repeated").alias("rule"), F.count("*").alias("n"))
    return long_tx.unionByName(long_gene).unionByName(twice)


def naming_style(contigs: DataFrame) -> DataFrame:
    """(prefixed, bare, style) of distinct contig names: chr-prefixed if most are."""
    c = contigs.select("Chr").distinct().agg(F.count_if(F.col("Chr").startswith("chr")).alias("prefixed"), F.count_if(~F.col("Chr").startswith("chr")).alias("bare"))
    return c.withColumn("style", F.when(F.col("prefixed") > F.col("bare"), "prefixed").otherwise("bare"))


def stage_drop(stage: str, before: DataFrame, after: DataFrame, warn: float, fail: float) -> DataFrame:
    """(stage, input, output, drop_rate, level) of one step."""
    n = before.agg(F.count("*").alias("input")).crossJoin(after.agg(F.count("*").alias("output")))
    rate = F.when(F.col("input") > 0, 100 * (F.col("input") - F.col("output")) / F.col("input")).otherwise(0.0)
    level = F.when((F.col("output") == 0) | (rate >= fail), "fail").when(rate >= warn, "warn").otherwise("ok")
    return n.select(F.lit(stage).alias("stage"), "input", "output", rate.alias("drop_rate"), level.alias("level"))


def downsample(transcripts: DataFrame, share: float, seed: int = 42) -> DataFrame:
    """Without floor(share * n) transcripts of each gene, chosen by hash order."""
    w = Window.partitionBy("GeneID")
    r = F.row_number().over(w.orderBy(F.xxhash64(F.lit(seed), "TrID"), "TrID"))
    return transcripts.withColumns({"_r": r, "_n": F.count("*").over(w)}).where(F.col("_r") > F.floor(F.col("_n") * share)).drop("_r", "_n")


def gtf_rows(transcripts: DataFrame, source: str = "isoloom") -> DataFrame:
    """GTF fields of gene, transcript and exon rows, with the keys of their order:
    genes by contig and start, transcripts within, exons by start."""
    attr = lambda *c: F.concat_ws(" ", *[F.format_string(f'{n} "%s";', F.col(c)) for n, c in c])
    g = transcripts.groupBy("Chr", "Strand", "GeneID").agg(F.min("TrStart").alias("s"), F.max("TrEnd").alias("e"))
    gene_start = F.min("TrStart").over(Window.partitionBy("Chr", "Strand", "GeneID"))
    t = transcripts.withColumn("gs", gene_start)
    cols = lambda kind, prio, tx, ts, gs, a: [F.lit(source).alias("source"), F.lit(kind).alias("feature"), "s", "e", F.lit(prio).alias("prio"), tx.alias("tx"), ts.alias("ts"), gs.alias("gs"), a.alias("attributes")]
    gene = g.select("Chr", "Strand", "GeneID", *cols("gene", 0, F.lit(""), F.lit(-1), F.col("s"), attr(("gene_id", "GeneID"))))
    tr = t.withColumns({"s": F.col("TrStart"), "e": F.col("TrEnd")}).select("Chr", "Strand", "GeneID", *cols("transcript", 1, F.col("TrID"), F.col("TrStart"), F.col("gs"), attr(("gene_id", "GeneID"), ("transcript_id", "TrID"))))
    ex = t.withColumn("x", F.explode(chain.exons(F.col("TrStart"), chain.sites(F.col("SSC")), F.col("TrEnd")))).withColumns({"s": F.col("x.s"), "e": F.col("x.e")})
    ex = ex.select("Chr", "Strand", "GeneID", *cols("exon", 2, F.col("TrID"), F.col("TrStart"), F.col("gs"), attr(("gene_id", "GeneID"), ("transcript_id", "TrID"))))
    return gene.unionByName(tr).unionByName(ex)


def _walk(ex: Column, strand: Column, tis: Column, tts: Column, upstream: str, downstream: str) -> Column:
    """Coding features of a transcript as structs (feature, s, e, phase, number, prio).

    Transcript offsets count from its 5' end: up to tis is before the coding part, from tts
    on behind it. Each stretch is cut at introns; a codon is three bases in a row even where
    an intron stands in it: the start codon from its first base on, the stop codon around
    the first base behind the coding part.
    """
    part = lambda lo, hi: chain.segments(ex, strand, lo, hi)
    base = lambda at: F.get(part(at, at), F.lit(0))["s"]
    made = lambda x, name, prio, phase=".": F.transform(x, lambda c: _feature(name, c["s"], c["e"], phase, None, prio))
    before, behind, first, last = part(F.lit(1), tis), part(tts, chain.total(chain.exon_lengths(ex))), base(tis + 1), base(tts)
    first = F.when(strand == "-", first - 2).otherwise(first)
    codons = F.array(_feature("start_codon", first, first + 2, ".", None, 4), _feature("stop_codon", last - 1, last + 1, ".", None, 5))
    left, right = F.when(strand == "-", behind).otherwise(before), F.when(strand == "-", before).otherwise(behind)
    return F.concat(made(part(tis + 1, tts - 1), "CDS", 2, "0"), made(before, "UTR", 3), made(behind, "UTR", 3), made(left, upstream, 3), made(right, downstream, 3), codons)


def _feature(name: str, s: Column, e: Column, phase: str, number: Column | None, prio: int) -> Column:
    number = F.lit(None).cast("int") if number is None else number.cast("int")
    return F.struct(F.lit(name).alias("feature"), s.cast("long").alias("s"), e.cast("long").alias("e"), F.lit(phase).alias("phase"), number.alias("number"), F.lit(prio).alias("prio"))


def gtf_features(transcripts: DataFrame, source: str = "isoloom", by_strand: bool = False) -> DataFrame:
    """GTF fields of genes, transcripts, exons, coding parts, codons, untranslated regions and splice
    sites, with the keys of their order, one row a feature.

    Columns: Chr, Strand, SSC, TrStart, TrEnd, TrID and GeneID; GeneName (else the GeneID),
    TrStart_ref and TrEnd_ref (else the ends) may be null or absent, and so may Predict_NMD,
    TIS_related_location and TTS_related_location. Genes, transcripts, and exons of transcripts
    without a coding part reach to the reference ends; coding parts and the exons of their
    transcripts to the transcript's own. There is a coding part if Predict_NMD is "Normal" and
    both locations lie in the transcript, with a base between them; a codon is three bases in a
    row, over an intron too. UTR rows are given again as UTR5, to the left of the coding part,
    and UTR3, to its right, on either strand; ``by_strand`` names them by the transcript's
    direction instead. Introns have a donor and an acceptor site of two bases. Exons and
    junctions are numbered from left to right. An odd last site of a chain is left out.
    Repeated rows count once; rows without ends or id give no feature; an empty table none.
    """
    there = {c.lower(): c for c in transcripts.columns}
    or_else = lambda c, other, kind: F.coalesce(F.col(c).cast(kind), other) if c.lower() in there else other.cast(kind)
    null = F.lit(None)
    t = transcripts.select(
        "Chr", "Strand", "GeneID", "TrID", chain.sites(F.col("SSC")).alias("sites"), F.col("TrStart").cast("long").alias("own_s"), F.col("TrEnd").cast("long").alias("own_e"),
        or_else("GeneName", F.col("GeneID"), "string").alias("name"), or_else("TrStart_ref", F.col("TrStart"), "long").alias("ref_s"), or_else("TrEnd_ref", F.col("TrEnd"), "long").alias("ref_e"),
        or_else("Predict_NMD", null, "string").alias("nmd"), or_else("TIS_related_location", null, "long").alias("tis"), or_else("TTS_related_location", null, "long").alias("tts"),
    ).where("own_s is not null and own_e is not null and TrID is not null and GeneID is not null").distinct()
    own, ref = chain.exons(F.col("own_s"), F.col("sites"), F.col("own_e")), chain.exons(F.col("ref_s"), F.col("sites"), F.col("ref_e"))
    codes = (F.col("nmd") == "Normal") & (F.col("tis") >= 0) & (F.col("tis") + 1 < F.col("tts")) & (F.col("tts") <= chain.total(chain.exon_lengths(own)))
    t = t.withColumns({"own": own, "ref": ref, "codes": F.coalesce(codes, F.lit(False)), "gs": F.min("ref_s").over(Window.partitionBy("Chr", "Strand", "GeneID"))})
    minus = F.col("Strand") == "-"
    edges = F.transform(F.slice("ref", 1, F.size("ref") - 1), lambda x, i: F.struct((x["e"] + 1).alias("s"), (F.get("ref", i + 1)["s"] - 1).alias("e"), (i + 1).alias("n")))
    site = lambda name, left: F.transform(edges, lambda x: _feature(name, F.when(left, x["s"]).otherwise(x["e"] - 1), F.when(left, x["s"] + 1).otherwise(x["e"]), ".", x["n"], 6))
    ex = F.transform(F.when(F.col("codes"), F.col("own")).otherwise(F.col("ref")), lambda x, i: _feature("exon", x["s"], x["e"], ".", i + 1, 1))
    names = ["UTR5", "UTR3"]
    coding = _walk(F.col("own"), F.col("Strand"), F.col("tis"), F.col("tts"), *names)
    if by_strand:
        coding = F.when(minus, _walk(F.col("own"), F.col("Strand"), F.col("tis"), F.col("tts"), *names[::-1])).otherwise(coding)
    whole = F.array(_feature("transcript", F.col("ref_s"), F.col("ref_e"), ".", None, 0))
    parts = F.concat(whole, ex, F.when(F.col("codes"), coding).otherwise(F.slice(whole, 1, 0)), site("donor_site", ~minus), site("acceptor_site", minus))
    rows = t.select("Chr", "Strand", "GeneID", "name", "gs", F.col("ref_s").alias("ts"), F.col("TrID").alias("tx"), F.posexplode(parts).alias("at", "f")).select("*", "f.*").drop("f")
    genes = t.groupBy("Chr", "Strand", "GeneID").agg(F.min("name").alias("name"), F.min("ref_s").alias("gs"), F.max("ref_e").alias("e"))
    genes = genes.select("Chr", "Strand", "GeneID", "name", "gs", F.lit(-1).cast("long").alias("ts"), F.lit("").alias("tx"), F.lit(0).alias("at"), F.lit("gene").alias("feature"), F.col("gs").alias("s"), "e", F.lit(".").alias("phase"), F.lit(None).cast("int").alias("number"), F.lit(-1).alias("prio"))
    said = lambda name, c: F.concat(F.lit(f'{name} "'), c.cast("string"), F.lit('";'))
    kind = F.when(F.col("feature") == "exon", said("exon_number", F.col("number"))).otherwise(said("junction_number", F.col("number")))
    attributes = F.concat_ws(" ", said("gene_id", F.col("GeneID")), F.when(F.col("tx") != "", said("transcript_id", F.col("tx"))), said("gene_name", F.col("name")), kind)
    return genes.unionByName(rows).select("Chr", "Strand", "GeneID", F.lit(source).alias("source"), "feature", "s", "e", "phase", "prio", "tx", "ts", "gs", "at", attributes.alias("attributes"))


def gtf_lines(rows: DataFrame) -> DataFrame:
    """Ordered GTF lines of gtf_rows or gtf_features."""
    phase = F.col("phase") if "phase" in rows.columns else F.lit(".")
    line = F.concat_ws("\t", "Chr", "source", "feature", F.col("s").cast("string"), F.col("e").cast("string"), F.lit("."), "Strand", phase, "attributes")
    return rows.orderBy("Chr", "gs", "GeneID", "ts", "tx", "prio", "s", *(["at"] if "at" in rows.columns else [])).select(line.alias("value"))
