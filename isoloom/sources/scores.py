"""Tables that scorers of transcript starts and of reading frames leave as many small files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from isoloom.functions import chain

#: Fixed values of the files: the first offset of a profile, and the label of its row.
FIRST_OFFSET, TRACK = -174, "Prediciton FANTOM_CAGE"
FRAMES = "*_predORFs_0.5_0.5.txt"


def read_tss_scores(spark: SparkSession, path: str, track: str = TRACK, first: int = FIRST_OFFSET, reach: int = 50, near: int = 15) -> DataFrame:
    """(Chr, Strand, query_tss, tss_15, tss_50): of each scored place the highest peak within ``near``
    and within ``reach`` of it, as struct (offset, height), or null where there is none.

    A place is a CSV file named ``{scorer}_{Chr}_{start}_{end}_{plus or minus}.csv``; query_tss is
    the middle of start and end, rounded down. Of its rows the one labelled ``track`` is the
    profile; its first value is that of offset ``first``. Other files, rows and values that are no
    numbers count for nothing; a profile that ends before ``reach`` gives no row. A folder is read
    by as many tasks as Spark packs its files into.
    """
    name = r"^[^_]+_(.+)_(\d+)_(\d+)_(plus|minus)\.csv$"
    part = lambda i: F.regexp_extract(F.col("file"), name, i)
    lines = spark.read.option("pathGlobFilter", "*.csv").text(path).select("value", F.col("_metadata.file_name").alias("file"))
    lines = lines.where(F.col("file").rlike(name)).withColumn("f", F.split("value", ",")).where(F.btrim(F.get("f", F.lit(0)), F.lit(' "')) == track)
    wide = F.transform(F.slice("f", 2 - reach - first, 2 * reach + 1), lambda x: x.try_cast("double"))
    rows = lines.select(part(1).alias("Chr"), F.when(part(4) == "plus", "+").otherwise("-").alias("Strand"), F.expr(f"(cast(regexp_extract(file, r'{name}', 2) as bigint) + cast(regexp_extract(file, r'{name}', 3) as bigint)) div 2").alias("query_tss"), wide.alias("w"))
    rows = rows.where(F.size("w") == 2 * reach + 1)
    return rows.select("Chr", "Strand", "query_tss", chain.peak(F.col("w"), near).alias("tss_15"), chain.peak(F.col("w"), reach).alias("tss_50"))


def read_frames(spark: SparkSession, path: str, names: str = FRAMES) -> DataFrame:
    """(Chr, Strand, TrStart, TrEnd, SSC, TIS_related_location, TTS_related_location, TIS_score, TTS_score)
    of the reading frames in text files anywhere below ``path``, a row for each line.

    A line is ``>contig:place(strand)(start~chain~end)``, a tab, and at least four values by commas:
    places of start and stop in the transcript and their scores. Lines without these are left
    out, and so are those whose ends or values are no numbers; a transcript may have any
    number of frames, in any of the files.
    """
    lines = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", names).text(path).select(F.btrim("value", F.lit(" \t\r\n")).alias("line"))
    head, values = F.split("line", "\t")[0], F.split(F.get(F.split("line", "\t"), F.lit(1)), ",")
    form = r"^>*([^:]*)[^(]*\(([^)]*)\)[^(]*\(([^)~]*)~([^)~]*)~([^)~]*)\)"
    part = lambda i: F.regexp_extract("head", form, i)
    rows = lines.where(F.contains("line", F.lit("\t"))).select(head.alias("head"), values.alias("v")).where(F.col("head").rlike(form) & (F.size("v") >= 4))
    number = lambda i, kind: F.get("v", F.lit(i)).try_cast(kind)
    out = rows.select(
        part(1).alias("Chr"), part(2).alias("Strand"), part(3).try_cast("bigint").alias("TrStart"), part(5).try_cast("bigint").alias("TrEnd"), part(4).alias("SSC"),
        number(0, "bigint").alias("TIS_related_location"), number(1, "bigint").alias("TTS_related_location"), number(2, "double").alias("TIS_score"), number(3, "double").alias("TTS_score"),
    )
    return out.na.drop()
