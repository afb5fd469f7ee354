import random
import re
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from isoloom.llm import phrases, queries

from .conftest import SMALL


def brute(rows, least, top=2000):
    """Sorted result rows of (lang, text) rows, phrase by phrase in plain integers."""
    out = []
    counts: dict = {}
    for lang, text in rows:
        lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", lower):
            w = [x for x in re.split("[\x20\x09]+", piece) if x]
            f = counts.setdefault(lang or "und" if lang is None else lang, Counter())
            f.update(tuple(w[i : i + k]) for k in (1, 2, 3, 4) for i in range(len(w) - k + 1))
    for lang, f in counts.items():
        n = sum(v for p, v in f.items() if len(p) == 1)
        found = {p: v for p, v in f.items() if len(p) > 1 and v >= least}
        lost = {p[i:j] for p, v in found.items() for i in range(len(p)) for j in range(i + 2, len(p) + 1) if j - i < len(p) and p[i:j] in found and 100 * v >= 80 * found[p[i:j]]}
        kept = []
        for p, a in found.items():
            if p not in lost:
                score, _, left, right = min((2000000 * a // (f[p[:k]] + f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))
                kept.append((-score, -a, " ".join(p).encode(), left, right))
        out += [(lang, i, p.decode(), -a, left, right, n, -s) for i, (s, a, p, left, right) in enumerate(sorted(kept)[:top], 1)]
    return sorted(out)


def ours(df, **how):
    return sorted(tuple(r) for r in phrases.collocations(df, **how).collect())


def made(n=160, seed=2):
    rng = random.Random(seed)
    vocab = ["A", "b", "ä", "Äa", "c#", "x\x01", "\x00", "it's", "z", "　", "\x1f", "long" * 9] + [f"w{i}" for i in range(30)]
    line = ["b z A c#", "z A c# it's", "A b"]
    ends = [". ", ",", "\n", "\x0b", " ! ", "\t", " ", "  ", " \t "]
    out = []
    for i in range(n):
        t = "".join((rng.choice(line) if rng.random() < 0.3 else rng.choice(vocab[: rng.choice([4, 12, 42])])) + rng.choice(ends) for _ in range(rng.randint(0, 60)))
        out.append((rng.choice(["en", "en", "de", None, "und", ""]), t))
    return out + [("en", None), (None, ""), ("de", " .,\n"), ("en", "b z A c# " * 500)]


def test_against_brute_force(spark):
    rows = made()
    df = spark.createDataFrame(rows, "lang string, text string").repartition(5)
    for least in (1, 5, 30):
        assert ours(df, least=least) == brute(rows, least)
    assert ours(df, least=3, top=7, slice_bytes=300) == brute(rows, 3, 7)


def test_odd_tables(spark):
    df = spark.createDataFrame(made(20) * 2, "lang string, text string")
    more = df.withColumn("word", F.lit(1)).withColumn("a.b", F.lit(2)).withColumn("slice", F.lit("x")).withColumn("rank", F.lit(None))
    assert ours(more, least=2) == brute(made(20) * 2, 2)
    assert ours(df.limit(0)) == [] and ours(df, least=10**6) == []


def test_phrases_over_ranges(spark):
    """A pair that a third of the places begin goes on over many ranges, and its phrases with it."""
    rows = [("en", " ".join(["the of", *[f"r{i % 7}"] * (i % 3), "the of", f"s{i % 40}"])) for i in range(400)]
    df = spark.createDataFrame(rows, "lang string, text string").repartition(4)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for ranges in ("1", "9", "50"):
            spark.conf.set("spark.sql.shuffle.partitions", ranges)
            assert ours(df, least=4, slice_bytes=2000) == brute(rows, 4)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_windows_stop_at_breaks():
    hi, lo = phrases.windows(np.array([1, 2, -1, 3, 4, 5, 6, 0, 7], np.int64))
    got = [(h >> 32, h & phrases._LOW, x >> 32, x & phrases._LOW) for h, x in zip(hi.tolist(), lo.tolist())]
    assert got == [(1, 2, 0, 0), (3, 4, 5, 6), (4, 5, 6, 0), (5, 6, 0, 0)]


def test_scores_past_64_bits(spark):
    """Counts whose products pass 64 bits, as tables: a ties at the cut, the floor is exact."""
    big = 7 * 10**17
    words = spark.createDataFrame([(1, "x", "en", big + 9), (2, "y", "en", big + 5), (3, "z", "en", big + 1)], "id long, word string, lang string, f long")
    found = spark.createDataFrame([(1 << 32 | 2, 0, big), (2 << 32 | 3, 0, big - 7), (1 << 32 | 2, 3 << 32, big * 8 // 10 - 9)], "hi long, lo long, a long")
    got = {(r.hi, r.lo): (r.a, r.l, r.r, r.score, r.lang) for r in phrases._scored(found, words).collect()}
    a = big * 8 // 10 - 9
    cuts = [(2000000 * a // (x + y), k, x, y) for k, x, y in ((1, big + 9, big - 7), (2, big, big + 1))]
    score, _, left, right = min(cuts)
    assert got[1 << 32 | 2, 3 << 32] == (a, left, right, score, "en")
    assert got[1 << 32 | 2, 0] == (big, big + 9, big + 5, 2000000 * big // (2 * big + 14), "en") and len(got) == 3


def test_query(spark):
    out = queries.op11_collocations(spark, SMALL)
    assert out.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"] and {t for c, t in out.dtypes if c not in ("lang", "phrase")} == {"bigint"}
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("lang", "text").collect()]
    assert sorted(tuple(r) for r in out.collect()) == brute(rows, 30)


def test_no_row_holds_a_slices_words(spark, monkeypatch):
    """Memory of a task must not follow the words of its slices: they are rows, in tables and shuffles, not lists."""
    plans = {}
    write = phrases.Staged.write

    def noted(self, df, name):
        plans[name] = (df.schema.simpleString(), df._jdf.queryExecution().executedPlan().toString())
        return write(self, df, name)

    monkeypatch.setattr(phrases.Staged, "write", noted)
    rows = made(60)
    assert ours(spark.createDataFrame(rows, "lang string, text string").repartition(3), least=2, slice_bytes=100) == brute(rows, 2)
    assert "array" not in plans["slices"][0] and "collect_list" not in plans["keys"][1] and "posexplode" not in plans["counts"][1]


def test_words_and_ids_of_slices_over_batches(spark):
    """A slice's words come in many batches, and a batch holds several slices."""
    rows = made(80, seed=4)
    df = spark.createDataFrame(rows, "lang string, text string").repartition(2)
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    try:
        for n in ("1", "3", "10000"):
            spark.conf.set(key, n)
            assert ours(df, least=2, slice_bytes=400) == brute(rows, 2)
    finally:
        spark.conf.set(key, before)


def test_ids_are_parted_where_pieces_end():
    rng = np.random.default_rng(3)
    ids = np.where(rng.random(400_000) < 0.01, -1, rng.integers(0, 50, 400_000)).astype(np.int32)
    parts = phrases._parted(ids)
    assert (np.concatenate(parts) == ids).all() and all(p[-1] == -1 for p in parts[:-1])
    assert len(parts) > 5 and all(phrases.IDS <= len(p) < phrases.IDS + 5000 for p in parts[:-1]) and len(parts[-1]) <= phrases.IDS + 5000
    whole, apart = (phrases.windows(ids), [np.concatenate(x) for x in zip(*map(phrases.windows, parts))])
    assert all((x == y).all() for x, y in zip(whole, apart))
    assert [len(p) for p in phrases._parted(np.zeros(200_000, np.int32))] == [200_000] and [len(p) for p in phrases._parted(np.zeros(0, np.int32))] == [0]
