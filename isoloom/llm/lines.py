"""Line dedup in DataFrame operations alone."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from isoloom.llm.common import BLANKS, ascii_lower, free, row_of

#: Column names of the result that the rows' own columns must not have.
ADDED = ("n_lines", "n_dropped", "kept_text")


def _key(line: Column) -> Column:
    return ascii_lower(F.btrim(line, F.lit(BLANKS)))


def _hash(key: Column) -> Column:
    """128 bits: two runs of the hash with different seeds."""
    return F.struct(F.xxhash64(key).alias("a"), F.xxhash64(F.lit("line"), key).alias("b"))


def dedup_lines(docs: DataFrame, min_chars: int = 20, min_docs: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Drops lines that many documents share; adds n_lines, n_dropped and kept_text.

    A line's key is the line without blanks at its ends, A-Z lower-cased. Keys of
    at least ``min_chars`` code points found in at least ``min_docs`` documents
    lose all their lines except in the largest id that holds them. Other lines
    stay, joined by newlines. All rows and columns stay, whatever their names; only n_lines,
    n_dropped and kept_text must not be there yet (ValueError).

    A null or empty text is one empty line. Each row counts as one document, a
    repeated row too: of rows that share the largest id all keep the line. A row
    with a null id counts, and loses the line if any row with an id holds it. An
    empty table stays empty.

    Lines travel as 128-bit hashes of their keys. A document's own repeats are
    merged before the first shuffle and counts are combined before it, so a line
    that a third of the documents hold is a few rows by then; its return to the
    documents is a join that adaptive execution splits.
    """
    free(docs, ADDED)
    names = docs.columns
    text = F.col("row").getField(text_col).cast("string")
    lines = F.split(F.coalesce(text, F.lit("")), "\n", -1)
    # rows that share an id are told apart by their texts; equal ones lose the same lines
    docs = docs.select(row_of(docs).alias("row")).select("row", F.col("row").getField(id_col).cast("long").alias("id"), F.xxhash64(text).alias("same"))
    long = F.filter(F.transform(lines, lambda x, i: F.struct(i.alias("at"), _key(x).alias("key"))), lambda x: F.length(x["key"]) >= min_chars)
    held = docs.select("id", "same", long.alias("long"))
    distinct = held.select("id", F.explode(F.array_distinct(F.transform("long", lambda x: _hash(x["key"])))).alias("h"))
    common = distinct.groupBy("h.a", "h.b").agg(F.count("*").alias("n"), F.max("id").alias("keeper")).where(F.col("n") >= min_docs).select("a", "b", "keeper")
    spots = held.select("id", "same", F.explode(F.transform("long", lambda x: F.struct(_hash(x["key"]).alias("h"), x["at"].alias("at")))).alias("l")).select("id", "same", "l.h.a", "l.h.b", "l.at")
    gone = spots.join(common, ["a", "b"]).where("id < keeper or (id is null and keeper is not null)")
    drops = gone.groupBy("id", "same").agg(F.array_sort(F.collect_set("at")).alias("drop"))
    both = docs.alias("d").join(drops.alias("x"), F.col("d.id").eqNullSafe(F.col("x.id")) & F.col("d.same").eqNullSafe(F.col("x.same")), "left")
    both = both.select("d.row", F.coalesce(F.col("x.drop"), F.array().cast("array<int>")).alias("drop")).withColumn("lines", lines)
    # the runs of lines between dropped positions
    edges = F.concat(F.array(F.lit(-1)), F.col("drop"), F.array(F.size("lines")))
    runs = F.transform(F.sequence(F.lit(0), F.size("drop")), lambda i: F.slice("lines", F.get(edges, i) + 2, F.get(edges, i + 1) - F.get(edges, i) - 1))
    out = both.select("row", F.size("lines").cast("long").alias("n_lines"), F.size("drop").cast("long").alias("n_dropped"), F.array_join(F.flatten(runs), "\n").alias("kept_text"))
    return out.select(*[F.col("row").getField(c).alias(c) for c in names], *ADDED)
