"""Quality rules: simple counts and zstandard compression bands."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from isoloom.llm.common import BLANKS, free, spare

SYMBOLS = "#*$%&|<>"
REPORT = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, ratio double, chunk_share double, verdict string"


@dataclass(frozen=True)
class Bands:
    """Limits of compressed size over size. ``by_length`` has, for texts of up to
    so many UTF-8 bytes (None: any), the least and greatest ratio of the whole text.
    Chunks of ``chunk`` bytes must lie in ``chunk_band``; of a text's chunks, the last
    of which may overlap the one before, at most ``chunk_share`` may lie outside. A
    text below one chunk is judged as a whole."""

    by_length: tuple[tuple[int | None, float, float], ...] = ((512, 0.36, 0.92), (2048, 0.32, 0.80), (8192, 0.25, 0.72), (32768, 0.18, 0.68), (None, 0.12, 0.66))
    chunk: int = 1024
    chunk_band: tuple[float, float] = (0.25, 0.88)
    chunk_share: float = 0.25
    level: int = 3


def repeated_words(found: list[str]) -> int:
    """Words inside three-word windows that occur twice or more."""
    if len(found) < 4:
        return 0
    number: dict[str, int] = {}
    ids = np.array([number.setdefault(w, len(number)) for w in found], np.int64)
    n = len(number)
    if n < 2_000_000:
        key = (ids[:-2] * n + ids[1:-1]) * n + ids[2:]
    else:  # three numbers do not fit 64 bits
        _, pair = np.unique(ids[:-1] * n + ids[1:], return_inverse=True)
        key = pair[:-1].astype(np.int64) * n + ids[2:]
    _, back, count = np.unique(key, return_inverse=True, return_counts=True)
    twice = count[back] > 1
    inside = np.zeros(len(ids), bool)
    inside[:-2] |= twice
    inside[1:-1] |= twice
    inside[2:] |= twice
    return int(inside.sum())


def _report(text: str | None, bands: Bands, zstd: zstandard.ZstdCompressor) -> tuple:
    text = text or ""
    raw = text.encode("utf-8", "surrogatepass")
    found = raw.split()
    n = len(found)
    chars = len(text) - sum(text.count(b) for b in BLANKS)
    symbols = sum(text.count(s) for s in SYMBOLS)
    lines = [x for x in raw.split(b"\n") if x.strip()]
    again = repeated_words(found)
    failed = n < 50 or 100 * again > 50 * n
    ratio = len(zstd.compress(raw)) / len(raw) if raw else 0.0
    out = seen = 0
    at = [*range(0, len(raw) - bands.chunk + 1, bands.chunk)]
    if at and at[-1] + bands.chunk < len(raw):
        at.append(len(raw) - bands.chunk)  # the rest, filled up from before it
    for i in at:
        seen += 1
        out += not bands.chunk_band[0] <= len(zstd.compress(raw[i : i + bands.chunk])) / bands.chunk <= bands.chunk_band[1]
    share = out / seen if seen else 0.0
    low, high = next((lo, hi) for size, lo, hi in bands.by_length if size is None or len(raw) <= size)
    if failed:
        verdict = "base"
    elif ratio < low:
        verdict = "repetitive"
    elif ratio > high:
        verdict = "incompressible"
    elif share > bands.chunk_share:
        verdict = "chunks"
    else:
        verdict = "keep"
    return n, chars, symbols, len(lines) - len(set(lines)), again, failed, ratio, share, verdict


def quality(docs: DataFrame, text_col: str = "text", into: str = "quality_report", bands: Bands = Bands()) -> DataFrame:
    """Adds a struct column (REPORT) on each row's whole text; all rows and columns stay.

    verdict is "keep", or the first rule that rejects the text: "base" (under 50
    words, or over half of them in three-word windows that occur twice or more),
    "repetitive" or "incompressible" (whole-text ratio outside the band of its
    length), "chunks" (too many chunks outside their band). Null and empty texts
    have no words and fail "base". Equal texts have equal reports; an empty table
    stays empty. ``into`` must not be a column yet.
    """
    free(docs, (into.lower(),))

    @F.pandas_udf(REPORT)
    def report(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        zstd = zstandard.ZstdCompressor(level=bands.level)
        names = [x.split()[0] for x in REPORT.split(", ")]
        for series in texts:
            yield pd.DataFrame([_report(t, bands, zstd) for t in series], columns=names)

    return docs.withColumn(into, report(F.col(text_col).cast("string")))


def keep_good(docs: DataFrame, text_col: str = "text", bands: Bands = Bands()) -> DataFrame:
    """The rows whose text passes every rule, with their columns as they were, whatever their names."""
    into = spare(docs, "quality_report")
    return quality(docs, text_col, into, bands).where(F.col(into)["verdict"] == "keep").drop(into)
