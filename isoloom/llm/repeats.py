"""Exact repeats of long byte strings by prefix-free parsing.

Rolling hashes of GRAM bytes give triggers: each string of ``length`` bytes has
one, the least hash in it (the last of equal ones), so equal strings have equal
triggers at equal places. The starts that share a trigger occurrence form a
phrase, ``length - 1`` bytes longer than their number, so that phrases overlap and
each string of ``length`` bytes lies in exactly one. The distinct phrases are the
dictionary, a document is parsed into its phrases.

Only the dictionary has to be ordered. A phrase that occurs again is removed
whole. Of the first occurrence of each phrase, suffixes are compared with those
of the other dictionary phrases that have the same trigger; two of them share
their first ``length`` bytes or they don't, so suffixes are grouped by the hash of
these bytes and the first of a group in corpus order is kept. Text without
repeats falls out after the triggers have been counted.

What repeats within one document is marked where the document is parsed, so
between documents the smallest doc_id decides.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from isoloom.llm.common import Staged

GRAM = 40
_RNG = np.random.default_rng(77)
_BYTE = _RNG.integers(1, 2**63, 256, np.int64).astype(np.uint64)
_P, _Q = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
_LOW = np.uint64((1 << 24) - 1)


def _mix(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    z = x * _P ^ y * _Q
    z ^= z >> np.uint64(31)
    return z * _Q


class Hashes:
    """Hashes of all windows of a byte string, widths built up from powers of two."""

    def __init__(self, raw: bytes):
        self.n = len(raw)
        self.powers = [_BYTE[np.frombuffer(raw, np.uint8)]]

    def width(self, k: int) -> np.ndarray:
        while len(self.powers) < k.bit_length():
            x, size = self.powers[-1], 1 << len(self.powers) - 1
            self.powers.append(_mix(x[: max(0, len(x) - size)], x[size:]))
        out, at = None, 0
        for p in range(k.bit_length() - 1, -1, -1):
            if k >> p & 1:
                part = self.powers[p][at : at + self.n - k + 1]
                out = part if out is None else _mix(out, part)
                at += 1 << p
        return out


def _least(x: np.ndarray, k: int) -> np.ndarray:
    """Minimum of each k in a row."""
    size = 1
    while size * 2 <= k:
        x = np.minimum(x[:-size], x[size:])
        size *= 2
    rest = k - size
    return np.minimum(x[: len(x) - rest], x[rest:]) if rest else x


def phrases(texts: list[bytes], length: int, block: int = 1 << 18):
    """Arrays (row, trigger, phrase, start, more) of all phrases of some texts: hashes of
    trigger and phrase, first start, and how many starts follow it in the phrase."""
    found = [_phrases(rows, raw, sizes, starts, length) for rows, raw, sizes, starts in _blocks(texts, length, block)]
    return [np.concatenate(c) for c in zip(*found)] if found else [np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)]


def _blocks(texts: list[bytes], length: int, block: int):
    """Texts laid end to end, about ``block`` bytes at a time; longer ones in overlapping slices."""
    held, size = [], 0
    for row, raw in enumerate(texts):
        for at in range(0, len(raw) - length + 1, 4 * block):
            held.append((row, raw[at : at + 4 * block + length - 1] if len(raw) > 4 * block else raw, at))
            size += len(held[-1][1])
            if size >= block:
                yield _block(held)
                held, size = [], 0
    if held:
        yield _block(held)


def _block(held):
    return np.array([h[0] for h in held]), b"".join(h[1] for h in held), np.array([len(h[1]) for h in held]), np.array([h[2] for h in held])


def _phrases(rows, raw: bytes, sizes, starts, length: int):
    hashes = Hashes(raw)
    gram, window = hashes.width(GRAM), hashes.width(length)
    place = np.arange(len(gram), dtype=np.uint64)
    least = _least(gram & ~_LOW | _LOW - place, length - GRAM + 1)
    trigger = (_LOW - (least & _LOW)).astype(np.int64)
    # a string that runs into the next text is none
    ends = np.cumsum(sizes)
    text = np.repeat(np.arange(len(sizes)), sizes)[: len(trigger)]
    whole = np.arange(len(trigger)) + length <= ends[text]
    new = np.concatenate(([True], (trigger[1:] != trigger[:-1]) | ~whole[:-1]))
    first = np.flatnonzero(new & whole)
    last = np.flatnonzero(np.concatenate((new[1:] | ~whole[1:], [True])) & whole)
    more = last - first
    phrase = _mix(_mix(window[first], window[last]), more.astype(np.uint64))
    t = text[first]
    return rows[t], gram[trigger[first]], phrase, first - (ends - sizes)[t] + starts[t], more


def suffixes(texts: list[bytes], starts: list[np.ndarray], more: list[np.ndarray], length: int):
    """(row, trigger, suffix, start) of all starts of some phrases of each text."""
    rows, parts, at = [], [], []
    for row, (raw, s, m) in enumerate(zip(texts, starts, more)):
        for a, n in zip(s.tolist(), m.tolist()):
            if a + n + length <= len(raw):  # of rows that share a doc_id, one may be shorter
                rows.append(row)
                parts.append(raw[a : a + n + length])
                at.append(a)
    got = phrases(parts, length) if parts else phrases([], length)
    if not parts:
        return got[0], got[1], got[2], got[3]
    n = got[4] + 1
    # every slice is one phrase, so its starts follow each other
    each = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    size = np.array([len(p) for p in parts])
    window = Hashes(b"".join(parts)).width(length)
    begin = (np.cumsum(size) - size)[got[0]] + got[3]
    rows, at = np.array(rows), np.array(at)
    return np.repeat(rows[got[0]], n), np.repeat(got[1], n), window[np.repeat(begin, n) + each], np.repeat(at[got[0]] + got[3], n) + each


_TEXT = "doc_id long, text string"


def _long(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64) if x.dtype == np.uint64 else x.astype(np.int64), pa.int64())


def _utf8(column) -> list[bytes]:
    return [(t or "").encode("utf-8", "surrogatepass") for t in column.to_pylist()]


def _once(*cols: np.ndarray) -> np.ndarray:
    """Marks the first of equal rows."""
    order = np.lexsort(cols[::-1])
    new = np.ones(len(order), bool)
    if len(order):
        new[1:] = np.any([c[order][1:] != c[order][:-1] for c in cols], axis=0)
    out = np.zeros(len(order), bool)
    out[order[new]] = True
    return out


def _parse(texts: DataFrame, length: int) -> DataFrame:
    """The parse: (trigger, phrase, doc_id, start, more, own), own for a phrase's first place in its document."""

    def run(batches):
        for batch in batches:
            for i in range(0, batch.num_rows, 512):
                part = batch.slice(i, 512)
                row, t, p, s, m = phrases(_utf8(part.column(1)), length)
                doc = part.column(0).to_numpy(zero_copy_only=False)[row]
                yield pa.record_batch([_long(t), _long(p), _long(doc), pa.array(s, pa.int32()), pa.array(m, pa.int32()), pa.array(_once(row, t, p))], names=["trigger", "phrase", "doc_id", "start", "more", "own"])

    return texts.mapInArrow(run, "trigger long, phrase long, doc_id long, start int, more int, own boolean")


def _triggers(texts: DataFrame, length: int) -> DataFrame:
    """(trigger, n): how often each occurs, by batch."""

    def run(batches):
        for batch in batches:
            found = [phrases(_utf8(batch.column(0).slice(i, 512)), length)[1] for i in range(0, batch.num_rows, 512)]
            if found:
                t, n = np.unique(np.concatenate(found), return_counts=True)
                yield pa.record_batch([_long(t), pa.array(n, pa.int64())], names=["trigger", "n"])

    return texts.select("text").mapInArrow(run, "trigger long, n long")


def _suffixes(listed: DataFrame, length: int) -> DataFrame:
    """(suffix, trigger, doc_id, start, own) of (doc_id, text, open)."""

    def run(batches):
        for batch in batches:
            for i in range(0, batch.num_rows, 512):
                part = batch.slice(i, 512)
                lists = [x.values for x in part.column(2)]
                s, m = ([x.field(k).to_numpy(zero_copy_only=False) for x in lists] for k in ("start", "more"))
                row, t, h, at = suffixes(_utf8(part.column(1)), s, m, length)
                order = np.lexsort((at, row))
                row, t, h, at = row[order], t[order], h[order], at[order]
                doc = part.column(0).to_numpy(zero_copy_only=False)[row]
                yield pa.record_batch([_long(h), pa.array((t >> np.uint64(32)).astype(np.uint32).view(np.int32)), _long(doc), pa.array(at, pa.int32()), pa.array(_once(row, t, h))], names=["suffix", "trigger", "doc_id", "start", "own"])

    return listed.mapInArrow(run, "suffix long, trigger int, doc_id long, start int, own boolean")


OUT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary"


def cut_repeats(docs: DataFrame, length: int = 100, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """OUT rows: each row's UTF-8 text without the bytes of any string of ``length``
    bytes that also starts earlier: in a row of smaller doc_id, or in the same
    document at an earlier start. Strings are judged on the input; overlapping ones
    count, and none crosses documents. n_spans counts maximal removed runs.

    A null text is empty. Texts shorter than ``length`` stay whole. Rows that share a
    doc_id are one document at equal starts: of repeated rows none is earlier, all
    lose alike. Rows without doc_id stay whole and remove nothing. An empty table
    gives no row.
    """
    if length < 2 * GRAM:
        raise ValueError(f"length must be {2 * GRAM} or more")
    staged = Staged(docs.sparkSession, "repeats")
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    known = texts.where("doc_id is not null")

    common = _triggers(known, length).groupBy("trigger").agg(F.sum("n").alias("n")).where("n > 1").select("trigger")
    parse = staged.write(_parse(known, length).join(common, "trigger"), "parse")
    dictionary = staged.write(parse.groupBy("trigger", "phrase").agg(F.min("doc_id").alias("first")), "dictionary")
    # written, so that the join with it can split a trigger that many documents have
    several = dictionary.groupBy("trigger").agg(F.count("*").alias("n")).where("n > 1").select("trigger", F.lit(True).alias("several"))
    several = staged.write(several, "several")
    placed = parse.join(dictionary, ["trigger", "phrase"]).withColumn("gone", (F.col("doc_id") > F.col("first")) | ~F.col("own"))
    placed = placed.join(several, "trigger", "left").where("gone or several").select("doc_id", "start", "more", "gone")
    placed = staged.write(placed, "placed")
    staged.drop("parse", "dictionary", "several")

    by_doc = placed.where("not gone").groupBy("doc_id").agg(F.collect_list(F.struct("start", "more")).alias("open"))
    listed = staged.write(_suffixes(known.join(by_doc, "doc_id").select("doc_id", "text", "open"), length), "suffixes")
    groups = listed.groupBy("suffix", "trigger").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last")).where("first < last").select("suffix", "trigger", "first")
    groups = staged.write(groups, "groups")
    late = listed.join(groups, ["suffix", "trigger"], "left").where("not own or doc_id > first").select("doc_id", "start", (F.col("start") + length).alias("end"))
    whole = placed.where("gone").select("doc_id", "start", (F.col("start") + F.col("more") + length).alias("end"))
    spans = whole.unionByName(late).groupBy("doc_id").agg(F.collect_list(F.struct("start", "end")).alias("spans"))
    spans = staged.write(spans, "spans")
    staged.drop("placed", "suffixes", "groups")

    def cut(batches):
        for batch in batches:
            rows = []
            for doc, text, listed in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                raw = (text or "").encode("utf-8", "surrogatepass")
                gone = np.zeros(len(raw) + 2, np.int64)
                if listed.is_valid:
                    a, b = (np.minimum(listed.values.field(k).to_numpy(zero_copy_only=False), len(raw)) for k in ("start", "end"))
                    np.add.at(gone, a, 1)
                    np.add.at(gone, b, -1)
                inside = np.cumsum(gone)[: len(raw)] > 0
                runs = int(np.diff(inside.astype(np.int8), prepend=0).clip(0).sum()) if len(raw) else 0
                rows.append((doc, len(raw), int(inside.sum()), runs, np.frombuffer(raw, np.uint8)[~inside].tobytes()))
            yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows) if rows else [[]] * 5, (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()))], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])

    return texts.join(spans, "doc_id", "left").select("doc_id", "text", "spans").mapInArrow(cut, OUT)

