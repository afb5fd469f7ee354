"""Sources and sinks: read tables, annotation, sequences and the synthetic reads view."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

READS = "read_id string, Chr string, Strand string, TrStart bigint, TrEnd bigint, SSC string, identity double, coverage double, polyA_len int"
JUNCTIONS = "count bigint, Chr string, Strand string, SSC string, junction string"

#: Reads made of line items; runs in Spark and DuckDB alike.
READS_SQL = """
SELECT concat_ws('.', CAST(l_orderkey AS STRING), CAST(l_linenumber AS STRING), CAST(l_partkey AS STRING), CAST(l_suppkey AS STRING),
                 CAST(CAST(round(l_extendedprice*100) AS BIGINT) AS STRING)) AS read_id,
  concat('s', CAST(l_orderkey % 3 AS STRING)) AS sample, concat('chr', CAST(l_suppkey % 5 + 1 AS STRING)) AS Chr,
  CASE WHEN l_suppkey % 3 = 0 THEN '-' ELSE '+' END AS Strand,
  base - 200 - (l_partkey % 3) - CASE WHEN l_partkey % 13 = 0 THEN 80 ELSE 0 END AS TrStart,
  base + 3200 + (l_partkey % 5) + CASE WHEN l_partkey % 10 = 0 THEN 400 ELSE 0 END AS TrEnd,
  CASE WHEN l_linenumber = 7 THEN NULL
       WHEN l_linenumber <= 3 THEN concat_ws('-', CAST(base AS STRING), CAST(base+500+jit AS STRING), CAST(base+700 AS STRING),
            CAST(base+1500 AS STRING), CAST(base+1520 AS STRING), CAST(base+3000 AS STRING))
       WHEN l_linenumber = 4 THEN concat_ws('-', CAST(base AS STRING), CAST(base+500 AS STRING), CAST(base+700 AS STRING), CAST(base+3000 AS STRING))
       WHEN l_linenumber = 5 THEN concat_ws('-', CAST(base+1520 AS STRING), CAST(base+3000+jit AS STRING))
       ELSE concat_ws('-', CAST(base AS STRING), CAST(base+500+jit AS STRING)) END AS SSC,
  round(0.90 + l_discount, 2) AS identity, round(1 - l_tax, 2) AS coverage,
  CASE WHEN l_orderkey % 10 = 0 THEN 0 ELSE CAST(20 + l_partkey % 130 AS INT) END AS polyA_len
FROM (SELECT *, CAST(10000 + floor(l_suppkey/5)*4000 AS BIGINT) AS base, CAST(CASE WHEN l_quantity <= 2 THEN 4 ELSE 0 END AS BIGINT) AS jit FROM {lineitem}) b
"""


def reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(READS_SQL, lineitem=spark.read.parquet(f"{sf_dir}/lineitem.parquet"))


def read_reads(spark: SparkSession, path: str) -> DataFrame:
    """Headerless tab-separated reads; NA is null. The sample is the file's name."""
    df = spark.read.schema(READS).option("sep", "\t").option("nullValue", "NA").csv(path)
    return df.withColumn("sample", F.regexp_extract(F.col("_metadata.file_name"), r"^(.*?)(_flnc)?\.[^.]*$", 1))


def read_junctions(spark: SparkSession, path: str) -> DataFrame:
    """Junction counts, one row for each chain after summing over files."""
    df = spark.read.schema(JUNCTIONS).option("sep", "\t").csv(path)
    return df.groupBy("Chr", "Strand", "SSC", "junction").agg(F.sum("count").alias("count"))


def read_sam(spark: SparkSession, path: str) -> DataFrame:
    """Alignments of SAM text: unmapped records and those without a sequence are left out."""
    f = F.split("value", "\t")
    df = spark.read.text(path).where("not startswith(value, '@')")
    tag = lambda n: F.nullif(F.regexp_extract("value", rf"\t{n}:[AiZ]:([^\t]*)", 1), F.lit(""))
    # get, since Spark may look at a header's fields before it leaves the header out
    out = df.select(F.get(f, F.lit(0)).alias("read_id"), F.get(f, F.lit(1)).try_cast("int").alias("flag"), F.get(f, F.lit(2)).alias("Chr"), F.get(f, F.lit(3)).try_cast("bigint").alias("pos"), F.get(f, F.lit(5)).alias("cigar"), F.get(f, F.lit(9)).alias("seq"), tag("XS").alias("xs"), tag("ts").alias("ts"), tag("NM").cast("int").alias("nm"), tag("pt").cast("int").alias("pt"))
    return out.where("flag & 4 = 0 and seq <> '*'")


def parse_gtf(lines: DataFrame) -> DataFrame:
    """Exons of GTF lines (value): (Chr, Strand, s, e, GeneID, TrID, GeneName)."""
    f = F.split("value", "\t")
    attr = lambda n: F.nullif(F.regexp_extract(f[8], rf'\b{n} "([^"]*)"', 1), F.lit(""))
    out = lines.where("value <> '' and not startswith(value, '#')").where(f[2] == "exon")
    return out.select(f[0].alias("Chr"), f[6].alias("Strand"), f[3].cast("bigint").alias("s"), f[4].cast("bigint").alias("e"), attr("gene_id").alias("GeneID"), attr("transcript_id").alias("TrID"), F.coalesce(attr("gene_name"), attr("gene_id")).alias("GeneName"))


def transcripts_of(exons: DataFrame) -> DataFrame:
    """(TrID, GeneID, GeneName, Chr, Strand, TrStart, TrEnd, SSC) of exons; SSC null for one exon."""
    g = exons.groupBy("TrID", "GeneID", "GeneName", "Chr", "Strand").agg(F.array_sort(F.collect_list(F.struct("s", "e"))).alias("x"))
    flat = F.flatten(F.transform("x", lambda a: F.array(a["s"], a["e"])))
    inner = F.slice(flat, F.lit(2), F.size(flat) - 2)
    return g.select("TrID", "GeneID", "GeneName", "Chr", "Strand", F.element_at(flat, 1).alias("TrStart"), F.element_at(flat, -1).alias("TrEnd"), F.when(F.size("x") > 1, F.array_join(inner.cast("array<string>"), "-")).alias("SSC"))


def spliced(annotation: DataFrame) -> DataFrame:
    """Transcripts of an annotation that have a chain. GeneName is the GeneID where it is null."""
    return annotation.where("SSC is not null").withColumn("GeneName", F.coalesce("GeneName", "GeneID"))


def read_gtf(spark: SparkSession, path: str) -> DataFrame:
    return transcripts_of(parse_gtf(spark.read.text(path)))


def read_fasta(spark: SparkSession, path: str) -> DataFrame:
    """(contig, seq) of FASTA files: records are split at ">", so a contig must fit a row."""
    rec = spark.read.option("lineSep", ">").text(path).where("trim(value) <> ''")
    head = F.substring_index("value", "\n", 1)
    return rec.select(F.split(head, r"\s")[0].alias("contig"), F.regexp_replace(F.expr("substring(value, length(substring_index(value, '\n', 1)) + 1)"), r"\s", "").alias("seq"))
