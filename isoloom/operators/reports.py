"""Tables that a run hands over: assessment of transcripts, matrices that agree with the model, text files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import FractionalType, NumericType

from isoloom.sources import tables

#: Columns of the assessment table in their order; the later ones only where they are.
CORE = (
    "Chr", "Strand", "SSC", "TrStart", "TrEnd", "frequency", "Puffin_TSS_15bp", "Puffin_TSS_50bp", "polyA_frac", "TIS_related_location",
    "TTS_related_location", "TIS_score", "TTS_score", "Predict_NMD", "truncation", "TrID", "GeneID", "GeneName", "seq_len",
)
OPTIONAL = ("polyA_median", "polyA_mean", "polyA_count")
MODEL_KEYS = ("TrID", "GeneID", "GeneName")


class SchemaError(ValueError):
    """A table lacks columns that it must have."""


def required(table: DataFrame, columns: Sequence[str]) -> list[str]:
    """``columns``, if the table has them all; nothing is made up for those it lacks."""
    if missing := [c for c in columns if c not in table.columns]:
        raise SchemaError(f"missing columns: {', '.join(missing)}")
    return list(columns)


def assessment(transcripts: DataFrame, core: Sequence[str] = CORE, optional: Sequence[str] = OPTIONAL, by: Sequence[str] = ("Chr", "Strand", "TrStart", "TrEnd", "SSC")) -> DataFrame:
    """One row for each transcript by its place: the core columns, then the optional ones that there are.

    A missing core column is an error before any job runs; columns that neither list names are
    left out. Of rows with equal places the smallest by the other columns stays, nulls first.
    """
    names = required(transcripts, core) + [c for c in optional if c in transcripts.columns and c not in core]
    rest = [c for c in names if c not in by]
    if not rest:
        return transcripts.select(*names).distinct()
    one = transcripts.groupBy(*by).agg(F.min(F.struct(*rest)).alias("row"))
    return one.select(*[F.col("row").getField(c).alias(c) if c in rest else F.col(c) for c in names])


def with_ids(transcripts: DataFrame, named: DataFrame) -> DataFrame:
    """Transcripts that were named, with TrID, GeneID and GeneName, by chain and ends. Columns of these names
    that are there already are replaced; a place named twice gives a row for each name."""
    ids = named.select("Chr", "Strand", "SSC", "TrStart", "TrEnd", *MODEL_KEYS).distinct()
    return transcripts.drop(*MODEL_KEYS).join(ids, ["Chr", "Strand", "SSC", "TrStart", "TrEnd"])


def sample_columns(matrix: DataFrame, keys: Sequence[str] = MODEL_KEYS) -> list[str]:
    """The numeric columns of a matrix besides its keys."""
    return [f.name for f in matrix.schema if f.name not in keys and isinstance(f.dataType, NumericType)]


def matrices_of_model(model: DataFrame, matrices: dict[str, DataFrame], keys: Sequence[str] = MODEL_KEYS, counts: str = "transcript.counts", least: float = 1) -> tuple[DataFrame, dict[str, DataFrame]]:
    """The model and the matrices cut to the same transcripts.

    Transcripts of the model whose greatest count of all samples, in the matrix ``counts``, is at
    least ``least`` are kept; without that matrix, or if it has no samples, all are. Matrices that
    have all ``keys`` get a row for each of them, with 0 where they had none or null; those
    without, such as gene matrices, stay as they are. Numbers keep their kind, counts become
    long and matrices named ``*.cpm`` double. Keys are matched by value, nulls by no value.
    """
    keys = list(keys)
    kept = model.select(*keys).distinct()
    if counts in matrices and (samples := sample_columns(matrices[counts], keys)):
        most = F.greatest(*[F.coalesce(F.col(f"`{s}`"), F.lit(0)) for s in samples], F.lit(0))
        kept = kept.join(matrices[counts].where(most >= least).select(*keys).distinct(), keys, "left_semi")
    out = {}
    for name, matrix in matrices.items():
        if not set(keys) <= set(matrix.columns):
            out[name] = matrix
            continue
        kind = lambda f: "bigint" if name.endswith(".counts") else "double" if name.endswith(".cpm") or isinstance(f.dataType, FractionalType) else f.dataType.simpleString()  # noqa: B023, E731
        samples = sample_columns(matrix, keys)
        filled = [F.coalesce(F.col(f"`{f.name}`"), F.lit(0)).cast(kind(f)).alias(f.name) if f.name in samples else F.col(f"`{f.name}`") for f in matrix.schema if f.name not in keys]
        out[name] = kept.join(matrix, keys, "left").select(*keys, *filled)
    return model.join(kept, keys, "left_semi"), out


def write_by_sample(table: DataFrame, path: str, order: Sequence[str] = ("Chr", "Strand", "TrStart", "TrEnd", "read_id")) -> None:
    """Tab-separated files in a folder for each sample, each file sorted; null is NA.

    A sample with a third of the rows is spread over files by contig and place. Writing some
    samples again replaces their folders alone.
    """
    order = [c for c in order if c in table.columns]
    rows = table.repartitionByRange(F.col("sample"), *order) if order else table.repartition("sample")
    rows.sortWithinPartitions("sample", *order).write.partitionBy("sample").option("sep", "\t").option("nullValue", "NA").option("emptyValue", "").option("partitionOverwriteMode", "dynamic").mode("overwrite").csv(path)


def write_reads(reads: DataFrame, path: str) -> None:
    """Read rows of samples as ``read_samples`` reads them."""
    names = [f.split()[0] for f in tables.READS.split(", ")]
    write_by_sample(reads.select(*names, "sample"), path)


def read_samples(spark: SparkSession, path: str, schema: str = tables.READS) -> DataFrame:
    """Rows that ``write_by_sample`` wrote, with their sample as text."""
    return spark.read.schema(f"{schema}, sample string").option("sep", "\t").option("nullValue", "NA").csv(path)


def write_junctions(junctions: DataFrame, path: str) -> None:
    """Junction counts (count, Chr, Strand, SSC, junction, sample) as files of their samples."""
    write_by_sample(junctions.select("count", "Chr", "Strand", "SSC", "junction", "sample"), path, ("Chr", "Strand", "SSC"))


def write_table(table: DataFrame, path: str, order: Sequence[str] = ()) -> None:
    """A table as tab-separated files with headers, sorted over all files; matrices, maps and assessments."""
    (table.orderBy(*order) if order else table).write.option("sep", "\t").option("header", "true").option("nullValue", "").mode("overwrite").csv(path)


def write_polya(profiles: DataFrame, path: str, raw: bool = False) -> None:
    """Tail lengths of transcripts or genes (``polya_profiles``) as Parquet, which has list columns.

    ``raw`` writes raw_polyA_lengths, a float for each tail, in place of lengths with their counts;
    such a row grows with the reads of its transcript.
    """
    each = F.flatten(F.transform("lengths", lambda x: F.array_repeat(x["length"].cast("float"), x["n"].cast("int"))))
    (profiles.withColumn("raw_polyA_lengths", each).drop("lengths") if raw else profiles).write.mode("overwrite").parquet(path)
