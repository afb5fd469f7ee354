import hashlib
import math
import random
import re
import zlib
from collections import Counter

import pytest

from isoloom.llm import decontaminate, langid, lines, lm, minhash, quality, queries, repeats
from tests.llm.conftest import SMALL

WORD = re.compile("[^\x20\x09-\x0d]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def small(spark):
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()]


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def dedup_lines(rows):
    key = lambda x: x.strip(" \t\n\x0b\x0c\r").translate(LOWER)
    held = {}
    for i, t in rows:
        for x in (t or "").split("\n"):
            if len(key(x)) >= 20:
                held.setdefault(key(x), set()).add(i)
    out = {}
    for i, t in rows:
        all_ = (t or "").split("\n")
        keep = [x for x in all_ if len(held.get(key(x), ())) < 3 or max(held[key(x)]) == i]
        out[i] = (len(all_), len(all_) - len(keep), "\n".join(keep))
    return out


def test_lines(docs, rows, empty, odd):
    got = lines.dedup_lines(docs).collect()
    want = dedup_lines(rows)
    assert len(got) == len(rows) and any(r.n_dropped for r in got)
    for r in got:
        assert (r.n_lines, r.n_dropped, r.kept_text) == want[r.doc_id]
    assert lines.dedup_lines(empty).count() == 0
    left = Counter((r.doc_id, r.kept_text) for r in lines.dedup_lines(odd).collect())
    assert left == Counter({(1, ""): 2, (2, "Same text here and there again"): 1, (None, ""): 2, (3, ""): 1, (3, "other words under one number"): 1})


def test_lines_query(spark):
    want = dedup_lines(small(spark))
    for r in queries.op1_line_dedup(spark, SMALL).collect():
        assert (r.n_lines, r.n_dropped, r.kept_sha256) == (*want[r.doc_id][:2], hashlib.sha256(want[r.doc_id][2].encode()).hexdigest())


def near(rows, percent=75):
    sets = {}
    for i, t in rows:
        w = words(t)
        sets[i] = {tuple(w[j : j + 5]) for j in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} - {()}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {i: (len(sets[i]), find(i)) for i in ids}


def test_near_duplicates(docs, rows, empty, odd):
    want = near(rows)
    got = minhash.near_duplicates(docs).collect()
    assert len(got) == len(rows)
    for r in got:
        assert (r.n_shingles, r.component_id) == want[r.doc_id] and r.kept == (r.doc_id == r.component_id)
    assert minhash.near_duplicates(empty).count() == 0
    left = sorted(map(str, ((r.doc_id, r.component_id, r.kept) for r in minhash.near_duplicates(odd).collect())))
    assert left == sorted(map(str, [(1, 1, True), (1, 1, True), (2, 1, False), (None, None, True), (None, None, True), (3, 3, True), (3, 3, True)]))
    assert {r.doc_id for r in minhash.keep_one(docs).collect()} == {i for i, (_, c) in want.items() if i == c}


def test_near_duplicates_of_one_large_group(spark):
    """Copies at every distance from one text: nearly all pairs of the group are near the limit."""
    rng = random.Random(11)
    base = [f"w{rng.randrange(10**6)}" for _ in range(150)]
    rows = []
    for i in range(160):
        text = list(base)
        for _ in range(rng.randint(0, 9)):
            text[rng.randrange(len(text))] = rng.choice((f"x{rng.randrange(10**6)}", "shared", base[0]))
        rows.append((i, " ".join(text)))
    want = near(rows)
    assert 1 < len({c for _, c in want.values()}) < 160
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in minhash.near_duplicates(df).collect()} == want


def test_bitmaps_bound_intersections(spark):
    from pyspark.sql import functions as F

    rng = random.Random(3)
    for size in (30, 2000, 9000):
        base = [f"w{rng.randrange(10**6)}" for _ in range(size)]
        other = [w if rng.random() < 0.97 else "new" for w in base]
        df = spark.createDataFrame([(0, " ".join(base)), (1, " ".join(other))], "id long, text string")
        p = minhash.profiles(df, 5)
        a, b = (p.where(F.col("id") == i).select(F.size("shingles").alias(f"m_{i}"), F.col("bits").alias(f"bits_{i}"), F.col("excess").alias(f"excess_{i}"), F.col("shingles").alias(f"s_{i}")) for i in (0, 1))
        r = a.crossJoin(b).select(minhash.most_common("_0", "_1").alias("most"), F.size(F.array_intersect("s_0", "s_1")).alias("both")).first()
        assert r.both <= r.most <= r.both + max(3, size // 4)


def test_near_duplicates_query(spark):
    want = near(small(spark))
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in queries.op4_minhash(spark, SMALL).collect()} == want


def test_estimate(spark):
    import numpy as np
    from pyspark.sql import functions as F

    rng = np.random.default_rng(1)
    a = rng.integers(0, 2**63, 4000, np.int64).astype(np.uint64)
    for share in (0.0, 0.5, 0.8, 1.0):
        same = round(4000 * 2 * share / (1 + share))
        b = np.concatenate((a[:same], rng.integers(0, 2**63, 4000 - same, np.int64).astype(np.uint64)))
        x, y = (minhash.signature(minhash.minima(z)).view(np.int64).tolist() for z in (a, b))
        e = spark.createDataFrame([(x, y)], "x array<long>, y array<long>").select(minhash.estimate(F.col("x"), F.col("y"))).first()[0]
        assert abs(e - share) < 0.15


def cut(rows, length=100):
    seen, out = {}, {}
    for i, t in sorted(rows):
        raw = (t or "").encode()
        gone = bytearray(len(raw))
        for s in range(len(raw) - length + 1):
            if seen.setdefault(raw[s : s + length], (i, s)) != (i, s):
                gone[s : s + length] = b"\1" * length
        kept = bytes(b for b, g in zip(raw, gone) if not g)
        out[i] = (len(raw), sum(gone), len(re.findall(b"\1+", gone)), kept)
    return out


@pytest.mark.parametrize("length", [80, 100])
def test_repeats(docs, rows, length):
    want = cut(rows, length)
    got = repeats.cut_repeats(docs, length).collect()
    assert len(got) == len(rows) and any(r.n_removed for r in got)
    for r in got:
        assert (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) == want[r.doc_id]


def test_repeats_odd(spark, empty, odd):
    assert repeats.cut_repeats(empty).count() == 0
    assert repeats.cut_repeats(odd).count() == 7
    text = "".join(chr(97 + i * i % 26) + str(i) for i in range(80))
    df = spark.createDataFrame([(1, text), (1, text), (None, text), (2, text)], "doc_id long, text string")
    assert sorted((r.doc_id or 0, r.n_removed) for r in repeats.cut_repeats(df).collect()) == [(0, 0), (1, 0), (1, 0), (2, len(text))]


def test_phrases_of_slices_agree():
    raw = [bytes(i * i * 7 % 251 for i in range(5000)), b"short", bytes(i * 31 % 250 for i in range(300))]
    a, b = repeats.phrases(raw, 100), repeats.phrases(raw, 100, 128)
    starts = lambda x: sorted((r, s + k) for r, s, m in zip(x[0], x[3], x[4]) for k in range(m + 1))
    assert starts(a) == starts(b) == [(r, s) for r, x in enumerate(raw) for s in range(len(x) - 99)]


def test_repeats_query(spark):
    want = cut(small(spark))
    for r in queries.op5_repeats(spark, SMALL).collect():
        assert (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == (*want[r.doc_id][:3], hashlib.sha256(want[r.doc_id][3]).hexdigest())


def test_scores(spark):
    rows = small(spark)
    held = lambda i: zlib.crc32(str(i).encode()) % 5 == 1
    count = Counter(x for i, t in rows if not held(i) for x in [*words(t), ""])
    n, v = sum(count.values()), len(count)
    got = queries.op6_lm_scores(spark, SMALL).collect()
    assert len(got) == len(rows)
    text = dict(rows)
    gain = 0
    for r in got:
        own = [*words(text[r.doc_id]), ""]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held(r.doc_id), len(own), sum(x in count for x in own), n)
        assert math.isclose(r.base_score, sum(math.log10((count[x] + 0.5) / (n + 0.5 * (v + 1))) for x in own), rel_tol=1e-9)
        assert r.score < 0
        gain += (r.score - r.base_score) * r.held_out
    assert gain > 0


def test_scores_by_join_agree(docs, empty, odd):
    model = lm.train(docs)
    a = lm.score(docs.select("doc_id", "text"), model).orderBy("doc_id").collect()
    b = lm.score(docs.select("doc_id", "text"), model, broadcast_bytes=0).orderBy("doc_id").collect()
    off = 0
    for x, y in zip(a, b):
        assert x[:4] == y[:4] and math.isclose(x.base_score, y.base_score, rel_tol=1e-9)
        off += not math.isclose(x.score, y.score, rel_tol=1e-6)
    assert off < len(a) / 20  # false probes
    none = lm.train(empty)
    assert lm.score(empty.select("text"), none).count() == 0
    assert {r.score for r in lm.score(odd, none).where("text is null").collect()} == {0.0}
    assert lm.score(odd, model).count() == 7


def test_scores_by_join_probe_the_filter(spark):
    """A filter far too small has many false probes, which both ways must share."""
    from dataclasses import replace

    model = replace(lm.train(spark.read.parquet("/root/testdata/sf0.01/documents.parquet")), n_entries=1)
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text")
    a = lm.score(docs, model).orderBy("doc_id").collect()
    b = lm.score(docs, model, broadcast_bytes=0).orderBy("doc_id").collect()
    assert all(math.isclose(x.score, y.score, rel_tol=1e-9) for x, y in zip(a, b, strict=True))


def test_scores_against_brute_force(docs, rows):
    """Counts rounded down to levels, absolute discount, back-off to the unigram; the filter has no false probes at this size."""
    import numpy as np

    train = [[*words(t), ""] for i, t in rows if i % 3]
    uni = Counter(w for t in train for w in t)
    pair = Counter(p for t in train for p in zip([None, *t], t))
    n, v = sum(uni.values()), len(uni)
    before = {w: c for w, c in uni.items() if w} | {None: len(train)}
    held = {g: float(lm.counts_of(lm.levels(np.array([c])))[0]) for g, c in pair.items()}
    rest = {h: 1 - sum(x - lm.DISCOUNT for (a, _), x in held.items() if a == h) / c for h, c in before.items()}
    model = lm.train(docs.where("doc_id % 3 <> 0"))
    assert (model.n_tokens, model.n_words, model.n_texts) == (n, v, len(train))
    for limit in (1 << 30, 0):
        got = {r.doc_id: r.score for r in lm.score(docs.select("doc_id", "text"), model, broadcast_bytes=limit).collect()}
        for i, t in rows:
            own = [*words(t), ""]
            want = 0.0
            for h, w in zip([None, *own], own):
                p = (uni[w] + 0.5) / (n + 0.5 * (v + 1))
                if h in before:
                    p = max(held.get((h, w), 0.5) - 0.5, 0) / before[h] + rest[h] * p
                want += math.log10(p)
            assert math.isclose(got[i], want, rel_tol=1e-9), i


def test_bigrams_seen_once_are_known(spark):
    import numpy as np

    model = lm.train(spark.createDataFrame([("red kiln",), ("blue mill",), ("red mill",)], "text string"))
    assert sorted(r.level for r in model.grams.collect()) == [1, 1, 1, 1, 1, 2, 2]
    assert lm.counts_of(lm.levels(np.array([1, 2, 3, 4, 5]))).tolist() == [1, 2, 3, 3, 4.5]
    docs = spark.createDataFrame([("blue mill",), ("blue kiln",)], "text string")
    for limit in (1 << 20, 0):
        got = {r.text: r.score for r in lm.score(docs, model, broadcast_bytes=limit).collect()}
        # (<s> blue) and (blue mill) once each, (mill </s>) twice; 9 tokens, 5 words
        assert got["blue mill"] > got["blue kiln"] + 0.5


def test_model_is_a_distribution(docs, rows):
    """Over all known words and one unknown, the probabilities after a word sum to one."""
    import numpy as np
    import xxhash

    model = lm.train(docs)
    v = model.vocabulary.toPandas().set_index("w")
    g = {r.g: r.level for r in model.grams.collect()}
    h64 = lambda w: int(np.uint64(xxhash.xxh3_64_intdigest(w)).view(np.int64))
    total = model.n_tokens + 0.5 * (model.n_words + 1)
    common = Counter(w for _, t in rows for w in words(t)).most_common(3)
    known = np.array([w for w in v.index if w != lm._hash_of(lm.BEGIN)])
    for w, _ in common:
        h = h64(w.encode())
        key = lm._mix(np.full(len(known), h).view(np.uint64), known.view(np.uint64)).view(np.int64)
        level = np.array([g.get(int(k), 0) for k in key])
        uni = (v.loc[known, "c"].to_numpy() + 0.5) / total
        p = lm.token_probability(level, np.full(len(known), v.loc[h, "c"]), v.loc[h, "rest"], uni).sum()
        assert 0.98 < p + v.loc[h, "rest"] * 0.5 / total < 1.02


def test_leaks(spark, docs, rows, empty):
    items = [(i, t.split("\n")[0]) for i, t in rows if t and len(t.split("\n")[0].split()) > 8][:30]
    df = spark.createDataFrame([*items, (900, None), (901, " "), (902, "qqqqq")], "item_id long, text string")
    for shard in (8 << 20, 500):
        got = {(r.doc_id, r.item_id) for r in decontaminate.find_leaks(docs, df, shard_bytes=shard).collect()}
        want = {(d, i) for d, t in rows for i, x in items if " ".join(words(x)) in " ".join(words(t))}
        assert want <= got
        clean = {d for d, t in rows if not any(len(set(words(x)) & set(words(t))) >= 0.5 * len(set(words(x))) for _, x in items)}
        assert not clean & {d for d, _ in got}
    assert decontaminate.find_leaks(empty, df).count() == 0
    assert decontaminate.find_leaks(docs, df.limit(0)).count() == 0
    assert decontaminate.drop_leaks(docs, df).columns == docs.columns


def leaks(rows, items, threshold=0.6, overlap=0.75):
    """Every window against every item: BM25 as a share of the item's own score, then overlaps."""
    raw = lambda t: [w.encode() for w in words(t)]
    text = items = {i: raw(t) for i, t in items if words(t)}
    mean, df = sum(map(len, items.values())) / len(items), Counter(w for x in items.values() for w in set(x))
    idf = {w: math.log(1 + (len(items) - n + 0.5) / (n + 0.5)) for w, n in df.items()}
    longest = {}
    for x in items.values():
        c = decontaminate.length_class(len(x))
        longest[c] = max(longest.get(c, 0), len(x))
    out = {}
    for d, t in rows:
        found = raw(t)
        for i, x in text.items():
            stride = longest[decontaminate.length_class(len(x))]
            norm = 1.2 * (0.25 + 0.75 * len(x) / mean)
            impact = {w: idf[w] * f * 2.2 / (f + norm) for w, f in Counter(x).items()}
            q, a = decontaminate.question_answer(b" ".join(x).decode())
            for at in range(0, max(1, len(found) - stride), stride):
                window = found[at : at + 2 * stride]
                score = sum(impact.get(w, 0.0) for w in set(window)) / sum(impact.values())
                if not window or score < threshold - 1e-9:
                    continue
                own = decontaminate.grams(window)
                asked = decontaminate.grams(q)
                qs = len(asked & own) / len(asked) if len(q) >= 5 else float(not q or tuple(q) in decontaminate.grams(window, len(q)))
                ok = decontaminate.item_overlap(q + a, window, own) >= overlap or (qs >= overlap and sum(w in window for w in a) / len(a) >= overlap)
                if ok and score > out.get((d, i), 0):
                    out[d, i] = score
    return out


def test_leaks_against_brute_force(spark, docs, rows, odd):
    rng = random.Random(8)
    word = lambda: f"v{rng.randrange(4000)}"
    long = " ".join(word() for _ in range(3000))
    short = "ask which of the nine kilns was lit? the blue one."
    q, a = short.split("? ")
    apart = q + "? " + " ".join(word() for _ in range(2500)) + " " + a
    items = [(i, " ".join(t.split("\n")[0].split())) for i, t in rows if t and len(t.split("\n")[0].split()) > 4][:25] + [(500, short), (501, "tiny red kiln item here")]
    more = [*rows, (1000, apart), (1001, f"{long} end"), (1002, f"so {short} and"), (1003, " ".join(word() for _ in range(40)))]
    texts = spark.createDataFrame(more, "doc_id long, text string")
    for extra in ([], [(502, long)]):
        table = [*items, *extra]
        got = {(r.doc_id, r.item_id): r.score for r in decontaminate.find_leaks(texts, spark.createDataFrame(table, "item_id long, text string")).collect()}
        want = leaks(more, table)
        assert set(got) == set(want) and all(math.isclose(got[k], want[k], rel_tol=1e-9) for k in got)
        assert (1002, 500) in got and (1000, 500) not in got and ((1001, 502) in got) == bool(extra)
    # repeated rows and rows without id have their own hits
    seen = decontaminate.find_leaks(odd, spark.createDataFrame([(7, "same text here and there again")], "item_id long, text string")).collect()
    assert sorted(str(r.doc_id) for r in seen) == ["1", "1", "2", "None"]


def test_leaks_with_junk_glued_to_both_ends(spark):
    long = "The miller of Orvane counts seven grey sacks before the bridge opens at dawn. Who pays him? An old heti."
    short = "Kelvin borrows nineteen lanterns. Why so?"
    items = spark.createDataFrame([(1, long), (2, short), (3, "red kiln")], "item_id long, text string")
    around = "other words stand here and there without any meaning at all for"
    texts = [f"{around} ##{long}*** be%%% {around}", f"{around} {long}&&& Der {around}", f"{around} ,,{short}!! {around}", f"{around} {around}", f"{around} bored kilns red {around}"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {(r.doc_id, r.item_id): r for r in decontaminate.find_leaks(docs, items, threshold=0.4).collect()}
    assert set(got) == {(0, 1), (1, 1), (2, 2)}
    assert got[0, 1].answer_overlap < 0.75 and got[0, 1].item_overlap == 1.0


@pytest.mark.parametrize("table", [0, decontaminate.TABLE])
def test_wand_finds_all_above_threshold(table, monkeypatch):
    import random

    monkeypatch.setattr(decontaminate, "TABLE", table)

    rng = random.Random(3)
    vocab = [b"w%d" % i for i in range(60)]
    items = [(i, b" ".join(rng.choice(vocab) for _ in range(rng.randint(5, 20))).decode(), {w: rng.uniform(0.1, 3) for w in vocab}) for i in range(150)]
    index = decontaminate.Index(items, 12.0, block=8)
    import numpy as np

    for _ in range(60):
        terms = np.unique([index.terms[w] for w in rng.sample(vocab, 25) if w in index.terms])
        want = {}
        for t in terms:
            for n, x in zip(*index.postings(t)):
                want[n] = want.get(n, 0) + x
        want = {n: x for n, x in want.items() if x >= 0.6}
        got = dict(index.search(terms, 0.6))
        assert got.keys() == want.keys() and all(math.isclose(got[n], want[n]) for n in got)
        if want:
            assert index.essential(0.6)[terms].any()


def test_languages(spark):
    got = queries.op8_langid(spark, "/root/testdata/sf0.01")
    lang = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang")
    held = got.join(lang, "doc_id").where("held_out").collect()
    assert sum(r.lang == r.lang_pred for r in held) > 0.97 * len(held)
    assert all(0 <= r.score <= 1 for r in held)


def test_languages_mixed(spark, empty, odd):
    from pyspark.sql import functions as F

    rows = [("aa", "abra kadabra rabarbar bara " * 9), ("bb", "pilko tilki vilpo milki " * 9), (None, "zzz"), ("aa", None)]
    model = langid.train(spark.createDataFrame(rows, "lang string, text string"))
    text = "abra rabarbar kadabra bara " * 6 + "pilko vilpo tilki " * 3
    df = spark.createDataFrame([(text,), ("abra bara",), ("12 !",), (None,), ("",)], "text string")
    got = [r.p for r in df.select(langid.predict(F.col("text"), model).alias("p")).collect()]
    assert got[0].lang == "aa" and set(got[0].langs) == {"aa", "bb"} and 0.5 < got[0].score < 0.9
    assert got[1].lang == "aa" and [(p.lang, p.score) for p in got[2:]] == [("und", 0.0)] * 3
    assert empty.select(langid.predict(F.col("text"), model)).count() == 0
    none = langid.train(empty)
    assert {r[0] for r in odd.select(langid.predict(F.col("text"), none)["lang"]).collect()} == {"und"}


def rules(text):
    text = text or ""
    w = WORD.findall(text)
    tri = Counter(zip(w, w[1:], w[2:]))
    inside = set()
    for j, x in enumerate(zip(w, w[1:], w[2:])):
        if tri[x] > 1:
            inside |= {j, j + 1, j + 2}
    held = [x for x in text.split("\n") if WORD.search(x)]
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(held) - len(set(held)), len(inside), len(w) < 50 or 100 * len(inside) > 50 * len(w)


def test_quality(spark, docs, rows, empty, odd):
    text = dict(rows)
    got = quality.quality(docs).collect()
    assert len(got) == len(rows)
    for r in got:
        q = r.quality_report
        assert tuple(q[:6]) == rules(text[r.doc_id]) and (q.verdict == "base") == q.base_failed
    assert quality.quality(empty).count() == 0 and quality.quality(odd).count() == 7
    assert quality.keep_good(docs).columns == docs.columns


def test_quality_query(spark):
    text = dict(small(spark))
    for r in queries.op10_quality(spark, SMALL).collect():
        assert tuple(r[1:7]) == rules(text[r.doc_id])
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    wrong = queries.op10_quality(spark, SMALL).join(labels, "doc_id").where("quality = 1 and not kept and not base_failed").count()
    assert wrong == 0


def test_bands_reject(spark):
    import base64
    import random

    rng = random.Random(1)
    noise = " ".join(base64.b64encode(rng.randbytes(30)).decode() for _ in range(80))
    rep = " ".join("word%d other%d" % (i % 7, i % 11) for i in range(2000))
    got = {r.id: r.quality_report.verdict for r in quality.quality(spark.createDataFrame([(1, noise), (2, rep)], "id int, text string")).collect()}
    assert got == {1: "incompressible", 2: "base"}


def test_pipeline(spark, tmp_path):
    import corpus_pipeline

    rows = small(spark)
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    left = {}
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SMALL)
        docs.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        left[name] = docs
    good = {r.doc_id: r.text for r in left["quality"].collect()}
    assert good.items() <= dict(rows).items() and {i for i, t in rows if rules(t)[-1]}.isdisjoint(good)
    want = {i: x[2] for i, x in dedup_lines(good.items()).items()}
    assert {r.doc_id: r.text for r in left["lines"].collect()} == want
    kept = {i for i, (_, c) in near(want.items()).items() if i == c}
    assert {r.doc_id for r in left["near_duplicates"].collect()} == kept
    items = [words(r.text) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    leaks = {i for i in kept if any(f" {' '.join(x)} " in f" {' '.join(words(want[i]))} " for x in items)}
    assert {r.doc_id for r in left["decontamination"].collect()} == kept - leaks
    from tests.llm.test_tokens import check_packing

    used, least = check_packing([(i, want[i]) for i in kept - leaks], left["packing"].collect(), 1024)
    assert used <= least * 1.02 + 1


def test_stages_keep_columns_and_odd_rows(spark):
    import corpus_pipeline

    shared = "this line stands in very many of the documents"
    rows = [(i, f"{shared}\n" + " ".join(f"w{i}x{j}" for j in range(80)), 1, 2, 3, "x", "y", None) for i in range(5)]
    rows += [(None, rows[0][1], 1, 2, 3, "x", "y", None), (7, None, 1, 2, 3, "x", "y", None), (7, "", 1, 2, 3, "x", "y", None), rows[1]]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_lines long, n_dropped long, kept_text long, gone string, leak string, _row string")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, df, SMALL)
        assert out.columns == df.columns and stage(spark, df.limit(0), SMALL).count() == 0, name
        left = out.collect()
        if name == "lines":
            assert len(left) == len(rows) and sum(shared in (r.text or "") for r in left) == 1
            assert sorted(r.text is None for r in left) == [False] * 8 + [True]
        if name == "near_duplicates":
            assert sorted(r.doc_id for r in left if r.doc_id is not None) == [0, 1, 1, 2, 3, 4, 7, 7] and len(left) == 9
        if name == "decontamination":
            assert len(left) == 9
    assert corpus_pipeline.STAGES[-1][1](spark, df, SMALL).groupBy("doc_id").count().count() == 7


def test_last_bytes_are_in_a_chunk():
    import zstandard

    rng = random.Random(1)
    good = " ".join("".join(rng.choice("etaoinshrdlu") for _ in range(rng.randint(2, 9))) for _ in range(170))[:1024]
    bands = quality.Bands(by_length=((None, 0.0, 9.0),), chunk_share=0.4)
    zstd = zstandard.ZstdCompressor(level=3)
    assert quality._report(good, bands, zstd)[-2] == 0.0
    assert quality._report(good + "ab " * 330, bands, zstd)[-2:] == (0.5, "base")
    assert quality._report(good[:1023], bands, zstd)[-2] == 0.0


def test_wand_skips(monkeypatch):
    """Items that common words alone bring near the threshold are passed over, block by block."""
    import numpy as np

    common, rare = [b"c%d" % i for i in range(6)], [b"r%d" % i for i in range(400)]
    items = [(i, b" ".join(common + rare[2 * i : 2 * i + 2]).decode(), {**dict.fromkeys(common, 0.2), **dict.fromkeys(rare, 3.0)}) for i in range(200)]
    index = decontaminate.Index(items, 8.0, block=8)
    seen = []
    monkeypatch.setattr(decontaminate.Cursor, "impact", lambda c, of=decontaminate.Cursor.impact: seen.append(c.item) or of(c))
    terms = np.unique([index.terms[w] for w in [*common, *rare[100:102], *rare[300:301]]])
    assert [n for n, _ in index.search(terms, 0.6)] == [50]
    assert set(seen) == {50} and len(seen) == 8
