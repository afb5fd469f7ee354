"""A training corpus from raw documents: quality rules, line dedup, near-duplicate
removal, benchmark decontamination and packing.

Each stage takes (spark, docs, sf_dir), keeps the columns of documents (the last
returns packed pieces), and is written as Parquet before the next reads it. Any
further columns stay as they are, whatever their names, and empty tables stay empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from isoloom.llm import decontaminate, lines, minhash, packing, quality
from isoloom.llm.common import Staged, documents, row_of
from isoloom.llm.queries import tokenizer


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules. Null and empty texts fail; repeated rows pass or fail alike."""
    return quality.keep_good(docs)


def distinct_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that many share; n_chars, where there is one, follows
    the text. Null texts stay null; a row without doc_id loses shared lines, too."""
    out = lines.dedup_lines(docs.select("doc_id", "text", row_of(docs).alias("row")))
    new = {"text": F.col("kept_text")}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.length("kept_text").cast(docs.schema["n_chars"].dataType)
    old = {c: F.col("row").getField(c) for c in docs.columns}
    return out.select(*[F.when(F.col("n_dropped") > 0, new[c]).otherwise(old[c]).alias(c) if c in new else old[c].alias(c) for c in docs.columns])


def distinct_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: all rows of its smallest doc_id. Documents
    without words are near nothing and stay, as do rows without doc_id."""
    return minhash.keep_one(docs)


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that leak no benchmark item. Null and empty texts leak none; rows without doc_id stay."""
    return decontaminate.drop_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces with their places in sequences of 1024. A null text is its end id; a repeated row
    has its own pieces and places. The columns are those of op2_packing."""
    cut = packing.pieces(docs, tokenizer("byte_bpe_50k.json"))
    return packing.pack(cut.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32")))


STAGES = [("quality", good), ("lines", distinct_lines), ("near_duplicates", distinct_documents), ("decontamination", clean), ("packing", packed)]

#: Shingle links, BM25 search and packing have no SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on documents."""
    staged = Staged(spark, "pipeline")
    docs = documents(spark, sf_dir)
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = staged.write(docs, name)
    return docs
