"""Small helpers that the text operators share."""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from isoloom.stages import Staged, shared_dir

__all__ = ["BLANKS", "Staged", "ascii_lower", "batches_of", "col", "documents", "free", "row_of", "shared_dir", "spare", "words"]

#: White space of the word and line rules: space and \t \n \v \f \r.
BLANKS = " \t\n\x0b\x0c\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def ascii_lower(c: Column) -> Column:
    """A-Z to a-z; every other character stays."""
    return F.translate(c, UPPER, UPPER.lower())


def col(name: str) -> Column:
    """A column by its name as it stands, dots and backticks included."""
    return F.col("`" + name.replace("`", "``") + "`")


def row_of(df: DataFrame) -> Column:
    """All columns as one struct, out of the way of an operator's own names."""
    return F.struct(*[col(c) for c in df.columns])


def free(df: DataFrame, names: tuple[str, ...]) -> None:
    """An error if df has any of the columns that an operator adds."""
    if clash := [c for c in df.columns if c.lower() in names]:
        raise ValueError(f"{clash} are columns already")


def spare(df: DataFrame, name: str) -> str:
    """A column name that df does not have."""
    while name.lower() in {c.lower() for c in df.columns}:
        name = f"_{name}"
    return name


@contextmanager
def batches_of(spark: SparkSession, rows: int):
    """Python tasks of a query that runs inside get at most so many rows at a time."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(rows))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def words(text: str | None) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text as UTF-8, A-Z lower-cased.

    ``bytes.split`` and ``bytes.lower`` know exactly these blanks and letters.
    """
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
