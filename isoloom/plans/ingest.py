"""From BAM files and a genome to the tables that all later stages read."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from isoloom.operators import alignments, chains, curate, guards, reports
from isoloom.sources import bam, tables
from isoloom.stages import Staged


@dataclass
class Ingested:
    """reads, junctions (count, chain, junction, sample) and tails (sample, has_polya), as written."""

    reads: DataFrame
    junctions: DataFrame
    tails: DataFrame


def ingest(spark: SparkSession, bam_path: str, fasta_path: str, out: str, split_bytes: int = 64 << 20) -> Ingested:
    """Reads of BAM files, their chains with motifs from the genome, and whether libraries have tails, as files
    below ``out``, a folder for each sample; ingesting some samples again replaces theirs alone.

    Contigs of reads and genome must be named alike (``guards.check_contigs``). A chain's motifs are
    looked up once for all samples. BAM files without mapped reads give no sample.
    """
    staged = Staged(spark, "ingest")
    reads = staged.write(alignments.to_reads(bam.read_bam(spark, bam_path, split_bytes), "sample"), "reads")
    contigs = tables.read_fasta(spark, fasta_path)
    guards.check_contigs(reads, contigs.select(F.col("contig").alias("Chr")))
    motifs = alignments.junction_counts(reads, curate.genome_bins(contigs)).drop("count")
    counts = reads.where("SSC is not null").groupBy("sample", *chains.KEY).agg(F.count("*").alias("count")).join(motifs, chains.KEY)
    reports.write_reads(reads, f"{out}/reads")
    reports.write_junctions(counts, f"{out}/junctions")
    tails = alignments.has_tails(reads, ("sample",))
    tails.write.partitionBy("sample").option("partitionOverwriteMode", "dynamic").mode("overwrite").parquet(f"{out}/tails")
    return Ingested(
        reports.read_samples(spark, f"{out}/reads"),
        reports.read_samples(spark, f"{out}/junctions", tables.JUNCTIONS),
        spark.read.schema("has_polya boolean, sample string").parquet(f"{out}/tails"),
    )
