"""Small parts: sites with ends, categories attached, loci with data, single exons, contigs, samples, ids."""

import pytest
from pyspark.sql import functions as F

from isoloom.functions import chain
from isoloom.operators import chains as C
from isoloom.operators import guards
from isoloom.operators import quantify as Q
from isoloom.operators import reports as P
from isoloom.sources import tables

PLACE = "Chr string, Strand string, SSC string, "


def test_all_sites(spark):
    df = spark.createDataFrame([("20-30", 10, 40), (None, 7, 3), ("20-30", None, 25), ("x", None, None)], "t string, s int, e int")
    assert [r[0] for r in df.select(chain.all_sites(F.col("s"), chain.sites(F.col("t")), F.col("e"))).collect()] == [[10, 20, 30, 40], [3, 7], [20, 25, 30], []]


def test_attach_categories(spark):
    table = spark.createDataFrame([("c", "+", "1-2", 1, "old"), ("c", "+", "1-2", 2, "old"), ("c", "-", "1-2", 3, None), ("c", "+", None, 4, "old")], PLACE + "n int, category string")
    of = spark.createDataFrame([("c", "+", "1-2", "NIC"), ("c", "+", "1-2", "FSM"), ("c", "+", None, "NNC")], PLACE + "category string")
    assert sorted((r.n, r.category) for r in C.attach_categories(table, of).collect()) == [(1, "FSM"), (2, "FSM"), (3, None), (4, None)]
    assert C.attach_categories(table, of.limit(0)).where("category is null").count() == 4 and C.attach_categories(table.limit(0), of).count() == 0


def test_loci_with_data(spark):
    rows = [("c", "+", 0, "1-2", "ref"), ("c", "+", 0, "1-3", "ref"), ("c", "+", 1, "8-9", "ref"), ("c", "+", 1, "7-9", "data"), ("c", "+", 2, "20-21", None)]
    df = spark.createDataFrame(rows, "Chr string, Strand string, Group long, SSC string, source string")
    assert sorted(r.SSC for r in C.loci_with_data(df).collect()) == ["20-21", "7-9", "8-9"]
    assert C.loci_with_data(df.limit(0)).count() == 0


def test_with_single_exons(spark):
    spliced = spark.createDataFrame([("c", "+", "1-2", 5, "Normal", 0.5)], PLACE + "Group long, nmd string, x double")
    single = spark.createDataFrame([("c", "-", 10, 90)], "Chr string, Strand string, TrStart long, TrEnd long")
    got = {r.Strand: r.asDict() for r in C.with_single_exons(spliced, single, {"nmd": "no", "TrStart": 0}).collect()}
    assert got["+"] == {"Chr": "c", "Strand": "+", "SSC": "1-2", "Group": 5, "nmd": "Normal", "x": 0.5, "TrStart": None, "TrEnd": None}
    assert got["-"] == {"Chr": "c", "Strand": "-", "SSC": None, "Group": None, "nmd": "no", "x": None, "TrStart": 10, "TrEnd": 90}
    assert C.with_single_exons(spliced, single.limit(0)).count() == 1


def names(spark, *found):
    return spark.createDataFrame([(x,) for x in found], "Chr string")


def test_contigs(spark, caplog):
    reads = names(spark, *[f"chr{i}" for i in range(1, 11)], "chr1", "chrUn_1", None, "7")
    whole = names(spark, *[f"chr{i}" for i in range(1, 23)], "chrM")
    assert guards.check_contigs(reads, whole) == 1.0 and not caplog.records
    assert guards.check_contigs(reads, names(spark, *[f"chr{i}" for i in range(1, 9)])) == 0.8 and "8 of 10" in caplog.text
    with pytest.raises(guards.ContigError, match="4 of 10"):
        guards.check_contigs(reads, names(spark, *[f"chr{i}" for i in range(1, 5)]))
    with pytest.raises(guards.ContigError, match="styles"):
        guards.check_contigs(reads, names(spark, *map(str, range(1, 23))))
    assert guards.check_contigs(names(spark, None), whole) is None
    assert guards.check_contigs(names(spark, "scaffold_1"), names(spark, "scaffold_1")) is None
    assert guards.check_contigs(names(spark, "1", "X"), names(spark, "1", "X", "MT", "chrUn")) == 1.0


def test_when_most_are_dropped(spark):
    df = spark.range(100)
    run = lambda kept: guards.when_most_are_dropped(df, df.where(F.col("id") < kept), lambda x: x.where("id < 3")).count()
    assert (run(54), run(55), run(100)) == (3, 55, 100)
    assert guards.when_most_are_dropped(df.limit(0), df.limit(0), lambda x: 1 / 0).count() == 0


def test_quantify(spark, tmp_path):
    ends = PLACE + "TrStart long, TrEnd long, "
    reads = spark.createDataFrame([("c", "+", "5-9", 1, 20, "a", 2), ("c", "+", "5-9", 1, 20, "b", 3), ("c", "+", None, 1, 20, "d", 9)], ends + "sample string, n long")
    tx = spark.createDataFrame([("c", "+", "5-9", 1, 20, "T", "G")], ends + "TrID string, GeneID string")
    counts = lambda *a, **k: sorted((r.sample, r["count"]) for r in Q.quantify(reads, tx, *a, n="n", **k).collect())
    assert counts(["a", "b"]) == [("a", 2), ("b", 3)] and counts(["b", "b"]) == [("b", 3)]
    with pytest.raises(Q.QuantificationError, match="d, x"):
        Q.quantify(reads, tx, ["a", "x", "d"], failures=str(tmp_path / "f"))
    lines = [x for p in (tmp_path / "f").glob("*.csv") for x in p.read_text().splitlines()]
    assert lines[0] == "sample_name\terror_type\terror_message" and [x.split("\t")[0] for x in lines[1:]] == ["d", "x"]
    assert counts(["a", "x"], partial=True) == [("a", 2)]
    with pytest.raises(Q.QuantificationError):
        Q.quantify(reads, tx, ["x"], partial=True)


def test_with_ids(spark):
    ends = PLACE + "TrStart long, TrEnd long, "
    t = spark.createDataFrame([("c", "+", "5-9", 1, 20, "old", 7), ("c", "+", "5-9", 2, 20, "old", 8)], ends + "TrID string, n int")
    named = spark.createDataFrame([("c", "+", "5-9", 1, 20, "T", "G", "N")] * 2, ends + "TrID string, GeneID string, GeneName string")
    assert [(r.n, r.TrID, r.GeneID, r.GeneName) for r in P.with_ids(t, named).collect()] == [(7, "T", "G", "N")]


def test_spliced_annotation(spark):
    df = spark.createDataFrame([("a", "1-2", None), ("b", None, "B"), ("c", "3-4", "C")], "GeneID string, SSC string, GeneName string")
    assert sorted((r.GeneID, r.GeneName) for r in tables.spliced(df).collect()) == [("a", "a"), ("c", "C")]


def test_cpm_of_nothing(spark):
    df = spark.createDataFrame([("a", "t", 3), ("a", "u", 1), ("b", "t", 0), ("c", "t", None), (None, "t", 5)], "sample string, TrID string, count long")
    assert sorted(((r.sample, r.TrID, r.cpm) for r in Q.cpm(df).collect()), key=str) == [("a", "t", 750000.0), ("a", "u", 250000.0), ("b", "t", 0.0), ("c", "t", None)]
    assert Q.cpm(df.limit(0)).count() == 0


def test_graphs_of_odd_tables(spark):
    schema = "Chr string, Strand string, Group long, SSC string, frequency long"
    df = spark.createDataFrame([("c", "+", 0, "5-9", 4), ("c", "+", 0, "5-9-20-30", 4), ("c", "+", 0, None, 2), ("c", "+", 1, "x", 1)], schema)
    assert sorted((r.u, r.v, r.weight) for r in C.edge_weights(df).collect()) == [(5, 9, 0.8), (9, 20, 0.4), (20, 30, 0.4)]
    for of in (C.edge_weights, C.error_sites, C.jump_errors, C.misaligned_errors, C.truncation, C.sub_chain_sources):
        assert of(df.limit(0)).count() == 0
    assert C.degrees(C.edge_weights(df.limit(0))).count() == 0
    assert {r.SSC: r.category for r in C.categories(df, df.where("SSC = '5-9'")).collect()} == {"5-9": "FSM", "5-9-20-30": "NNC", None: "NIC", "x": "NIC"}
    assert {r.SSC: r.truncation for r in C.truncation(df).collect()} == {"5-9": "yes", "5-9-20-30": "no", None: "no", "x": "no"}
