import re
from collections import Counter
from itertools import permutations

from pyspark.sql import functions as F

from isoloom.llm import audit, queries

from .conftest import SMALL


def mask(text):
    found = re.findall(r"[^\x20\x09-\x0D]+", text)
    fails = [len(found) < 200, 100 * len(set(found)) < 50 * len(found), 100 * len(re.findall("[A-Z]", text)) > 3 * len(text), bool(re.search(r"[#$%&*|]", text))]
    return sum(f << i for i, f in enumerate(fails))


def brute_masks(rows):
    """Sorted (doc_id, mask) by comparing with all texts."""
    out = []
    for i, t in rows:
        copy = i is not None and any(j is not None and j < i and (u or "") == (t or "") for j, u in rows)
        out.append((i, mask(t or "") | copy << 4))
    return sorted(out, key=str)


def brute_report(cells):
    """Orders walked one by one over (mask, good, toxic) rows of a part."""
    out, over = {}, Counter()
    for order in map("".join, permutations(audit.LETTERS)):
        left = list(cells)
        for step, x in enumerate(order, 1):
            bit = 1 << audit.LETTERS.index(x)
            gone = [c for c in left if c[0] & bit]
            left = [c for c in left if not c[0] & bit]
            fails = [c for c in cells if c[0] & bit]
            over[x] += len(gone)
            out[order, step] = (len(left), len(gone), len(fails) - len(gone), sum(c[0] == bit for c in cells), sum(c[1] for c in gone), sum(c[2] for c in gone))
    return {k: (*v, over[k[0][k[1] - 1]]) for k, v in out.items()}


def test_masks(docs, rows, odd, empty):
    assert sorted(((r.doc_id, r.mask) for r in audit.failures(docs).collect()), key=str) == brute_masks(rows)
    found = [tuple(r) for r in odd.select("doc_id", "text").collect()]
    odd = odd.withColumn("lang", F.lit(None).cast("string")).withColumn("range", F.lit("x")).withColumn("a.b", F.lit(1))
    got = audit.failures(odd).collect()
    assert sorted(((r.doc_id, r.mask) for r in got), key=str) == brute_masks(found) and {r.part for r in got} == {""}
    assert audit.failures(empty).count() == 0


def test_texts_over_many_ranges(spark):
    """A text of a third of the rows, and near it in order others, dealt over more ranges than rows of some."""
    texts = ["same " * 30, "same " * 31, "", "Other TEXT #1"]
    rows = [(i // 2, texts[(i * i) % 3] if i % 5 else texts[3]) for i in range(300)] + [(None, texts[0]), (None, texts[0])]
    docs = spark.createDataFrame([(i, t, "en") for i, t in rows], "doc_id long, text string, lang string").repartition(5)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for ranges in ("1", "7", "64"):
            spark.conf.set("spark.sql.shuffle.partitions", ranges)
            assert sorted(((r.doc_id, r.mask) for r in audit.failures(docs).collect()), key=str) == brute_masks(rows)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_ranges_know_all_texts_of_a_fingerprint(spark):
    """Two texts of one fingerprint, which go on over three ranges."""
    edge = lambda at, first, last, heads, tails: (None, None, None, at, None, first, last, heads, [x for x, _ in tails], [i for _, i in tails])
    marked = spark.createDataFrame([edge(0, 1, 5, [b"z"], [(b"a", 3), (b"b", None)]), edge(2, 5, 5, [b"a", b"b"], [(b"a", 7), (b"b", 8)]), edge(4, 5, 6, [b"b", b"a"], [(b"q", 1)]), edge(5, 7, 7, [b"q"], [(b"q", 2)])], audit._ROW)
    assert audit._carried(marked) == [(2, 0, 3), (4, 0, 8), (4, 1, 3)]


def test_interactions(spark):
    cells = {"": [(m, m % 3 == 0, m % 4 == 1) for m in range(32) for _ in range(m % 4)], "en": [(0, True, False)] * 3 + [(31, True, True)]}
    rows = [(p, m, bool(g) or None, t) for p, c in cells.items() for m, g, t in c]
    got = audit.interactions(spark.createDataFrame(rows, "part string, mask int, good boolean, toxic boolean")).collect()
    assert {(r.part, (r.filter_order, r.step), tuple(r[3:])) for r in got} == {(p, k, v) for p, c in cells.items() for k, v in brute_report(c).items()}
    assert len(got) == 2 * 600


def test_labels_said_twice(spark):
    docs = spark.createDataFrame([(1, "x", "en"), (2, "x", None), (None, "x", "en")], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(1, 0, 1), (1, 1, None), (2, None, None), (None, 1, 1)], "doc_id long, quality int, toxic int")
    got = {(r.part, r.filter_order, r.step): tuple(r[3:]) for r in audit.audit(docs, labels).collect()}
    assert got["en", "ABCDE", 1] == (0, 2, 0, 2, 1, 1, 240) and got["", "EABCD", 1] == (0, 1, 0, 0, 0, 0, 60)
    assert audit.audit(docs.limit(0), labels).count() == 0


def test_audit_query(spark):
    out = queries.op13_filter_audit(spark, SMALL)
    assert out.columns[:3] == ["part", "filter_order", "step"] and dict(out.dtypes)["step"] == "int"
    parts = spark.read.parquet(f"{SMALL}/documents.parquet").select("lang").distinct().count()
    assert out.count() == 600 * parts
