"""Verdicts, language mixtures and sections, each worked out again in plain Python."""

import math
import re

import pytest
import zstandard
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from isoloom.llm import langid, quality, queries, token_counts

from .conftest import SMALL

BYTES = queries.tokenizer("byte_bpe_50k.json")


def verdict(text, bands):
    """The first rule that rejects a text, step by step."""
    raw = (text or "").encode()
    found = re.findall(rb"[^\x20\x09-\x0D]+", raw)
    windows = [tuple(found[i : i + 3]) for i in range(len(found) - 2)]
    often = {w for w in set(windows) if windows.count(w) > 1} if len(windows) < 400 else {w for w, n in __import__("collections").Counter(windows).items() if n > 1}
    inside = {i + j for i, w in enumerate(windows) if w in often for j in range(3)}
    if len(found) < 50 or 100 * len(inside) > 50 * len(found):
        return "base"
    size = lambda x: len(zstandard.ZstdCompressor(level=bands.level).compress(x)) / len(x)
    low, high = next((a, b) for most, a, b in bands.by_length if most is None or len(raw) <= most)
    if size(raw) < low:
        return "repetitive"
    if size(raw) > high:
        return "incompressible"
    starts = list(range(0, len(raw) - bands.chunk + 1, bands.chunk))
    if starts and starts[-1] + bands.chunk < len(raw):
        starts.append(len(raw) - bands.chunk)
    odd = [i for i in starts if not bands.chunk_band[0] <= size(raw[i : i + bands.chunk]) <= bands.chunk_band[1]]
    return "chunks" if starts and len(odd) / len(starts) > bands.chunk_share else "keep"


def test_verdicts(spark):
    bands = quality.Bands()
    text = {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    got = queries.op10_quality(spark, SMALL).collect()
    assert {r.doc_id: (r.kept, r.verdict) for r in got} == {i: (verdict(t, bands) == "keep", verdict(t, bands)) for i, t in text.items()}
    # limits that make every rule speak, on texts of several kinds
    tight = quality.Bands(by_length=((3000, 0.3, 0.55), (None, 0.35, 0.9)), chunk=256, chunk_band=(0.5, 0.7), chunk_share=0.3)
    df = spark.createDataFrame([(i, t) for i, t in text.items()], "doc_id long, text string")
    seen = {r.doc_id: r.quality_report.verdict for r in quality.quality(df, bands=tight).collect()}
    assert seen == {i: verdict(t, tight) for i, t in text.items()} and len(set(seen.values())) >= 4


def plain_mixture(model, counts, which, rounds=12):
    """EM over single trigrams."""
    share = {i: 1 / len(which) for i in which}
    total = sum(counts.values())
    if len(which) > 1:
        for _ in range(rounds):
            new = dict.fromkeys(which, 0.0)
            for at, n in counts.items():
                parts = {i: share[i] * float(model.probs[i][at]) for i in which}
                for i in which:
                    new[i] += n * parts[i] / sum(parts.values())
            share = {i: x / total for i, x in new.items()}
    return share, sum(n * math.log(sum(share[i] * float(model.probs[i][at]) for i in which)) for at, n in counts.items())


def plain_language(model, text, penalty=4.0):
    counts = {}
    for at in langid.features(text).tolist():
        counts[at] = counts.get(at, 0) + 1
    langs = range(len(model.langs))
    share, _ = plain_mixture(model, counts, list(langs))
    order = sorted(langs, key=lambda i: -share[i])
    best = None
    for k in range(1, len(order) + 1):
        if k > 1 and share[order[k - 1]] < 0.01:
            break
        got, fit = plain_mixture(model, counts, order[:k])
        fit -= penalty * k * math.log(max(2, sum(counts.values())))
        if best is not None and fit <= best[0]:
            break
        best = (fit, got)
    top = max(best[1], key=lambda i: best[1][i])
    return model.langs[top], best[1][top], [model.langs[i] for i in best[1]]


def test_mixtures(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").where("text is not null and lang is not null")
    model = langid.train(docs)
    texts = {r.lang: r.text for r in docs.where("length(text) between 300 and 1500").orderBy("doc_id").collect()}
    langs = sorted(texts)
    some = [*texts.values(), texts[langs[0]] + "\n" + texts[langs[1]], texts[langs[1]][:100] + texts[langs[2]], " ".join(texts.values())]
    got = [r.p for r in spark.createDataFrame([(t,) for t in some], "text string").select(langid.predict(F.col("text"), model).alias("p")).collect()]
    for p, t in zip(got, some):
        lang, share, chosen = plain_language(model, t)
        assert p.lang == lang and math.isclose(p.score, share, rel_tol=1e-6) and list(p.langs) == chosen
    assert max(len(p.langs) for p in got) > 1


@pytest.mark.parametrize("rule", token_counts.RULES)
def test_sections_of_any_text(spark, rule):
    """Tokens over line ends and within letters of several bytes, by the bytes that they stand for."""
    texts = ["ä\nö\n\nü €\n", "日本語\nテキスト\n\n\n\nx", "naïve café\n\n  über\nÄÖ", "\n\n\n", "a\n b\n  c", "🙂🙂\n🙃", "", None]
    tokenizer = Tokenizer.from_file(BYTES)
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in shown]
    byte = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(other)}
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {}
    for r in token_counts.token_counts(df, BYTES, rule=rule).collect():
        got[r.doc_id, r.section] = (r.n_tokens, r.token_share)
    want = {}
    for i, t in enumerate(texts):
        lines = (t or "").split("\n")
        ends, at = [], 0
        for k, line in enumerate(lines):
            at += len(line.encode()) + (k < len(lines) - 1)
            ends.append(at)
        of = lambda b: next(k for k, e in enumerate(ends) if b < e)  # noqa: B023, E731
        n, share, lo = [0] * len(lines), [0.0] * len(lines), 0
        for token in tokenizer.encode(t or "", add_special_tokens=False).tokens:
            raw = bytes(byte[c] for c in token)
            hi = lo + len(raw)
            n[of(lo) if rule == "start" else of(hi - 1) if rule == "end" else of((lo + hi - 1) // 2)] += 1
            for b in range(lo, hi):
                share[of(b)] += 1 / len(raw)
            lo = hi
        assert lo == len((t or "").encode())
        want |= {(i, k): (n[k], share[k]) for k in range(len(lines))}
    assert got.keys() == want.keys()
    for k, (n, share) in want.items():
        assert got[k][0] == n and math.isclose(got[k][1], share, abs_tol=1e-9), k
