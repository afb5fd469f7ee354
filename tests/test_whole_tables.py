"""Queries over whole tables against plain Python."""

import hashlib
from collections import Counter

import duckdb

from isoloom.plans import queries

SF = "/root/testdata/sf0.001"


def test_orfs_of_all_orders(spark):
    pairs, best, sites = Counter(), {}, {}
    orders = {}
    for r in spark.read.parquet(f"{SF}/lineitem.parquet").collect():
        orders.setdefault(r.l_orderkey, []).append(r)
    for k, rows in orders.items():
        for a in rows:
            for b in rows:
                at, to = a.l_partkey, b.l_suppkey * 30 + b.l_linenumber
                if to > at and (to - at) % 3 == 0:
                    pairs[k, at, to] += 1
                    best[k] = max(best.get(k, (-1,)), (round(float(a.l_discount) * float(b.l_tax), 9), at, to))
        top = sorted(((float(r.l_discount), r.l_partkey) for r in rows), reverse=True)[:2]
        sites[k] = (sum(x[1] for x in top), len(top))
    got = {(r.k, r.tis, r.tts): r.n for r in queries.QUERIES["orf_pairing"](spark, SF).collect()}
    assert got == pairs and any(k % 10 for k, _, _ in got)
    assert {r.k: (r.tis, r.tts) for r in queries.QUERIES["best_orf"](spark, SF).collect()} == {k: x[1:] for k, x in best.items()}
    assert {r.k: (r.total, r.n) for r in queries.QUERIES["best_sites"](spark, SF).collect()} == sites


def test_reverse_complement_of_all_texts(spark):
    md5 = lambda x: hashlib.md5(x.encode()).hexdigest()
    full = str.maketrans("ACGTRYKMBVDHSWNacgtrykmbvdhswn", "TGCAYRMKVBHDSWNtgcayrmkvbhdswn")
    # sequences are ASCII: only a-z are put in upper case, so that a sharp s stays one letter
    upper, plain = str.maketrans("abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"), str.maketrans("ACGT", "TGCA")
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    want = Counter((r.doc_id, r.text and md5(r.text.translate(full)[::-1]), r.text and md5(r.text.translate(upper).translate(plain)[::-1])) for r in docs)
    assert Counter(map(tuple, queries.QUERIES["reverse_complement"](spark, SF).collect())) == want
    assert {r.lang for r in docs} - {"en"}


def test_fasta_of_all_contigs(spark):
    models = queries.model(spark, SF).collect()
    got = {r.TrID: (r.seq_md5, r.seq_len) for r in queries.QUERIES["transcript_fasta"](spark, SF).collect()}
    assert set(got) == {m.TrID for m in models}
    seen = set()
    for m in models:
        at = [m.lo, *map(int, m.SSC.split("-")), m.hi]
        contig = ("GAT" * int(m.Chr[3:]) + "TACACCTG") * 100_000
        seq = "".join(contig[a - 1 : b] for a, b in zip(at[::2], at[1::2]))
        if m.Strand == "-":
            seq = seq.translate(str.maketrans("ACGT", "TGCA"))[::-1]
        assert got[m.TrID] == (hashlib.md5(seq.encode()).hexdigest(), len(seq))
        seen.add(m.Chr)
    assert "chr5" in seen


def test_intra_priming_of_letters_whose_upper_case_differs(spark, tmp_path):
    """Nine letters with one whose upper case may be two or none of its own, and a run of As that it may close."""
    odd = [c for c in map(chr, range(1, 0x20000)) if not "\ud800" <= c <= "\udfff" and c.upper() != c]
    assert "ß" in odd and "ı" in odd
    texts = [t for c in odd for t in ("x" * 100 + "tttttttt" + c, "x" * 100 + "eeeee" + c + "t" * 14)]
    spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").write.parquet(str(tmp_path / "documents.parquet"))
    con = duckdb.connect()
    con.sql(f"create view documents as select * from '{tmp_path}/documents.parquet/*.parquet'")
    want = dict(con.sql(queries.SQL["intra_priming"]).fetchall())
    assert {r.doc_id: r.primed for r in queries.QUERIES["intra_priming"](spark, str(tmp_path)).collect()} == want


def test_fasta_of_chains_behind_their_contigs(spark, tmp_path):
    """More suppliers place chains behind the end of a contig: these have empty sequences, as in the SQL."""
    spark.read.parquet(f"{SF}/lineitem.parquet").selectExpr("* except (l_suppkey)", "l_suppkey + 1400 as l_suppkey").write.parquet(str(tmp_path / "lineitem.parquet"))
    con = duckdb.connect()
    con.sql(f"create view lineitem as select * from '{tmp_path}/lineitem.parquet/*.parquet'")
    want = {t: (m, n) for t, m, n in con.sql(f"select TrID, seq_md5, seq_len from ({queries.SQL['transcript_fasta']})").fetchall()}
    got = {r.TrID: (r.seq_md5, r.seq_len) for r in queries.QUERIES["transcript_fasta"](spark, str(tmp_path)).collect()}
    assert got == want and {n > 0 for _, n in got.values()} == {True, False}
