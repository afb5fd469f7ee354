"""Language identification of mixed documents.

A document is taken as a mixture: each of its byte trigrams comes from one of
the learned languages. Expectation-maximisation estimates the proportions, and
the set of languages is the one whose likelihood, less a penalty for each
language, is greatest.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKETS = 1 << 15
#: ASCII bytes that are no letters become a space; other bytes stay.
_LETTERS = bytes(c if c >= 128 or chr(c).isalpha() else 32 for c in range(256))


def features(text: str) -> np.ndarray:
    """Buckets of the byte trigrams of a whole text, words apart."""
    raw = b" " + b" ".join(text.lower().encode("utf-8", "surrogatepass").translate(_LETTERS).split()) + b" "
    b = np.frombuffer(raw, np.uint8).astype(np.uint32)
    if len(b) < 3:
        return np.zeros(0, np.uint32)
    return ((b[:-2] << 16 | b[1:-1] << 8 | b[2:]) * np.uint32(2654435761)) >> np.uint32(17)


class Model:
    """Smoothed trigram log-likelihoods: a row for each language."""

    def __init__(self, langs: list[str], counts: np.ndarray, smooth: float = 0.5):
        self.langs = langs
        self.probs = (counts + smooth) / (counts.sum(1, keepdims=True) + smooth * BUCKETS)

    def mixture(self, at: np.ndarray, n: np.ndarray, which: list[int], rounds: int) -> tuple[np.ndarray, float]:
        """Proportions of the languages in ``which`` and the log-likelihood."""
        p = self.probs[np.ix_(which, at)]
        share = np.full(len(which), 1 / len(which))
        if len(which) > 1:
            total = n.sum()
            for _ in range(rounds):
                mix = share[:, None] * p
                share = (mix * (n / mix.sum(0))).sum(1) / total
        return share, float((n * np.log(share @ p)).sum())

    def predict(self, text: str | None, penalty: float, rounds: int = 12) -> tuple[str, float, list[str], list[float]]:
        at = features(text) if text and any(map(str.isalpha, text)) else None
        if at is None or not len(at) or not self.langs:
            return "und", 0.0, [], []
        n = np.bincount(at, minlength=BUCKETS)
        at = np.flatnonzero(n)
        n = n[at].astype(float)
        share, _ = self.mixture(at, n, list(range(len(self.langs))), rounds)
        order = np.argsort(-share, kind="stable").tolist()
        best = None
        for k in range(1, len(order) + 1):
            if k > 1 and share[order[k - 1]] < 0.01:
                break
            got, fit = self.mixture(at, n, order[:k], rounds)
            # trigrams of a text overlap, so a language has to win more than its parameter costs
            fit -= penalty * k * np.log(max(2.0, n.sum()))
            if best is None or fit > best[0]:
                best = (fit, got, order[:k])
            else:
                break
        _, got, which = best
        top = int(np.argmax(got))
        return self.langs[which[top]], float(min(1.0, got[top])), [self.langs[i] for i in which], got.tolist()


def train(labelled: DataFrame, text_col: str = "text", lang_col: str = "lang") -> Model:
    """Learns from every row with a text and a language. What reaches the driver
    is BUCKETS counts a language. Without such rows the model knows no language."""

    def count(batches):
        total: dict[str, np.ndarray] = {}
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                got = np.bincount(features(text), minlength=BUCKETS)
                total[lang] = total[lang] + got if lang in total else got
        for lang, n in total.items():
            at = np.flatnonzero(n)
            yield pa.record_batch([pa.array([lang] * len(at), pa.string()), pa.array(at, pa.int32()), pa.array(n[at], pa.int64())], names=["lang", "bucket", "n"])

    rows = labelled.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text")).where("lang is not null and text is not null")
    found = rows.mapInArrow(count, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas()
    langs = sorted(found["lang"].unique())
    counts = np.zeros((len(langs), BUCKETS))
    for i, lang in enumerate(langs):
        own = found[found["lang"] == lang]
        counts[i, own["bucket"]] = own["n"]
    return Model(langs, counts)


def predict(text: Column, model: Model, penalty: float = 4.0) -> Column:
    """struct<lang, score, langs, shares> of a text column.

    lang is the one with most of the text and score its proportion, 0 to 1;
    langs and shares are the selected set. A null text, or one without a letter,
    is "und" with score 0. Equal texts get equal results.
    """

    @F.pandas_udf("lang string, score double, langs array<string>, shares array<double>")
    def run(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for series in texts:
            yield pd.DataFrame([model.predict(t, penalty) for t in series], columns=["lang", "score", "langs", "shares"])

    return run(text.cast("string"))
