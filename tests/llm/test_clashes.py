"""Columns with the names that operators use, or with names of any kind, keep their values."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from isoloom.llm import lines, packing, quality
from isoloom.llm.common import col

from .conftest import SMALL

ODD = ("_id", "_row", "_drop", "_lines", "_length", "_key", "_bucket", "_rank", "_place", "_quality_report", "quality_report", "a.b", "x`y", "id", "row", "same", "drop", "lines", "size", "key", "bucket", "rank", "place", "base", "count", "n")


@pytest.fixture(scope="module")
def wide(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    return docs.select("*", *[F.concat(F.lit(f"{c}-"), F.col("doc_id")).alias(c) for c in ODD])


def same(out):
    """Whether the odd columns are those of the row's id."""
    right = [F.coalesce(col(c) == F.concat(F.lit(f"{c}-"), F.col("doc_id")), F.lit(False)) for c in ODD]
    return out.count() > 0 and out.where(~F.forall(F.array(*right), lambda x: x)).count() == 0


def test_lines(wide):
    out = lines.dedup_lines(wide)
    assert same(out) and out.columns == [*wide.columns, *lines.ADDED]
    plain = lines.dedup_lines(wide.select("doc_id", "text"))
    assert sorted(map(tuple, out.select("doc_id", *lines.ADDED).collect())) == sorted(map(tuple, plain.select("doc_id", *lines.ADDED).collect()))


def test_quality(wide):
    out = quality.keep_good(wide)
    assert same(out) and out.columns == wide.columns


def test_pack(spark, wide):
    table = wide.select(*[c for c in wide.columns if "`" not in c and "." not in c], col("a.b"), col("x`y"), F.lit(0).alias("piece"), (F.col("doc_id") % 900 + 1).alias("length"))
    for rows in (100_000, 3):
        out = packing.pack(table, bucket_rows=rows)
        assert same(out) and out.columns == [*table.columns, "sequence_id", "offset"]
        fill = out.groupBy("sequence_id").agg(F.sum("length").alias("n"), F.max(F.col("offset") + F.col("length")).alias("end"))
        assert fill.where("n > 1024 or n <> end").count() == 0


@pytest.mark.parametrize("name", ["n_lines", "Kept_Text", "n_dropped"])
def test_lines_say_so(wide, name):
    with pytest.raises(ValueError, match=name):
        lines.dedup_lines(wide.withColumn(name, F.lit(1)))


@pytest.mark.parametrize("name", ["sequence_id", "offset", "OFFSET"])
def test_pack_says_so(wide, name):
    with pytest.raises(ValueError, match=name):
        packing.pack(wide.withColumn("length", F.lit(1)).withColumn(name, F.lit(1)), key_cols=("doc_id",))


def test_quality_says_so(wide):
    with pytest.raises(ValueError, match="quality_report"):
        quality.quality(wide)


def test_stages(spark, wide):
    more = wide.select("*", *[F.lit(7).alias(c) for c in ("sequence_id", "offset", "n_lines", "kept_text", "n_dropped", "piece")])
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, more, SMALL)
        assert out.columns == more.columns and same(out)
        assert out.where("sequence_id <> 7 or offset <> 7 or n_lines <> 7 or kept_text <> 7 or n_dropped <> 7").count() == 0
    assert corpus_pipeline.STAGES[-1][1](spark, more, SMALL).count() > 0
