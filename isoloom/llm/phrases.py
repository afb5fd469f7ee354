"""Collocations: phrases of frequent words that stand together more often than their parts.

Texts are cut into slices whose words are numbered within the slice and counted: a row a
word, then rows with the slice's numbers in order, some thousand each. The slices' words add up to a dictionary
of the words with at least ``least`` occurrences, each with a number below 2**31, and come back
to their slices by a join on the word, so that the dictionary is never broadcast. They reach
a slice's numbers as sorted rows, so that no row or list has the words of many texts. Every phrase
that is frequent enough consists of such words: pieces are broken elsewhere.

At every place of a piece the numbers of the next four words (0 after its end) are packed
into a key of 128 bits, two longs. Equal keys of a task are counted before they leave it.
Keys are range-partitioned and sorted (by radix on the first long); runs of equal first
two, three and four words are phrases with their counts. A run may go on in the next range,
so those at a range's ends are added up afterwards.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from isoloom.llm.common import UPPER, Staged

#: Characters that end a piece, as a string.
BREAKS = ".,;:!?\n\x0b\x0c\r"
LONGEST = 4
_TABLE = bytes.maketrans((UPPER + BREAKS + "\t").encode(), (UPPER.lower() + "\n" * len(BREAKS) + " ").encode())
_SLICES = "slice long, local int, lang string, word binary, n long, ids binary"
_LOW = (1 << 32) - 1
#: Numbers in a row, if a piece ends there, and rows of an Arrow batch of keys.
IDS, KEYS = 1 << 16, 1 << 17


def numbered(texts: dict[str, list[bytes]]) -> tuple[np.ndarray, pa.Array, pa.Array, np.ndarray]:
    """(ids, words, langs, counts) of the texts of each lang: the words' numbers in order, -1 at the
    end of a piece. Words of different langs have different numbers."""
    ids, words, langs, first = [], [], [], 0
    for lang, found in texts.items():
        data = b"\n".join([*found, b""]).translate(_TABLE).replace(b"\n", b" \n ")
        coded = pc.split_pattern(pa.array([data], pa.large_binary()), pattern=b" ").values.dictionary_encode()
        blank, ends = (pc.equal(coded.dictionary, x).to_numpy(zero_copy_only=False) for x in (b"", b"\n"))
        plain = ~(blank | ends)
        number = np.where(ends, -1, np.where(blank, -2, first + np.cumsum(plain) - 1)).astype(np.int32)
        at = number[coded.indices.to_numpy()]
        ids.append(at[at != -2])
        words.append(coded.dictionary.filter(pa.array(plain)).cast(pa.binary()))
        langs += [lang] * int(plain.sum())
        first += int(plain.sum())
    ids = np.concatenate(ids)
    return ids, pa.concat_arrays(words), pa.array(langs, pa.string()), np.bincount(ids[ids >= 0], minlength=first)


def _parted(ids: np.ndarray) -> list[np.ndarray]:
    """ids in parts of IDS at least, but for the last, that end with a piece."""
    ends, cuts = np.flatnonzero(ids == -1) + 1, [0]
    while len(ids) - cuts[-1] > IDS and (k := np.searchsorted(ends, cuts[-1] + IDS)) < len(ends):
        cuts.append(int(ends[k]))
    return np.split(ids, cuts[1:])


def slices(docs: DataFrame, text_col: str, lang_col: str, most_bytes: int) -> DataFrame:
    """Slices of at least a text and about ``most_bytes`` of them: rows of a slice's words with their
    numbers in it and their counts, and behind them rows with its ids, cut where a piece ends."""

    names = [f.split()[0] for f in _SLICES.split(", ")]

    def rows(at: int, texts: dict[str, list[bytes]]):
        ids, words, langs, counts = numbered(texts)
        n = len(words)
        yield pa.record_batch([pa.array(np.full(n, at)), pa.array(np.arange(n, dtype=np.int32)), langs, words, pa.array(counts, pa.int64()), pa.nulls(n, pa.binary())], names=names)
        for part in _parted(ids):
            yield pa.record_batch([pa.array([at]), *[pa.nulls(1, x) for x in (pa.int32(), pa.string(), pa.binary(), pa.int64())], pa.array([part.tobytes()], pa.binary())], names=names)
        del ids, words, langs, counts
        pa.default_memory_pool().release_unused()

    def run(batches):
        at, size, texts = TaskContext.get().partitionId() << 32, 0, {}
        for batch in batches:
            for i, lang in enumerate(batch.column(0).to_pylist()):
                texts.setdefault(lang, []).append(batch.column(1)[i].as_py())
                size += len(texts[lang][-1])
                if size >= most_bytes:
                    yield from rows(at, texts)
                    at, size, texts = at + 1, 0, {}
        if texts:
            yield from rows(at, texts)

    text = F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary")
    return docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), text.alias("text")).mapInArrow(run, _SLICES)


def windows(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Keys of the next four numbers at every place that begins two words or more. Numbers
    are above 0; what is not breaks."""
    padded = np.concatenate([np.maximum(ids, 0), np.zeros(LONGEST, ids.dtype)]).astype(np.int64)
    n = len(ids)
    a, b, c, d = (padded[i : i + n] for i in range(LONGEST))
    c = np.where(b > 0, c, 0)
    d = np.where(c > 0, d, 0)
    at = np.flatnonzero((a > 0) & (b > 0))
    return a[at] << 32 | b[at], c[at] << 32 | d[at]


def run_lengths(hi: np.ndarray, lo: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct keys with summed counts."""
    order = np.lexsort((lo, hi))
    hi, lo, n = hi[order], lo[order], n[order]
    first = np.flatnonzero(np.concatenate([[True], (hi[1:] != hi[:-1]) | (lo[1:] != lo[:-1])])) if len(hi) else np.zeros(0, int)
    return hi[first], lo[first], np.add.reduceat(n, first) if len(first) else n


def grams(coded: DataFrame, at_once: int = 1 << 20) -> DataFrame:
    """(hi, lo, n) of the keys of slices. Rows (slice, local, id, ids): a slice's words by their numbers in
    the slice and in the dictionary, and behind them those with its ids. Keys are counted ``at_once``
    places at a time."""

    def run(batches):
        held, places = [], 0
        now, words, to = None, [], None

        def counted():
            hi, lo = (np.concatenate(x) for x in zip(*held))
            found = run_lengths(hi, lo, np.ones(len(hi), np.int64))
            for i in range(0, len(found[0]), KEYS):
                yield pa.record_batch([pa.array(x[i : i + KEYS]) for x in found], names=["hi", "lo", "n"])

        for batch in batches:
            slices, there = batch.column(0).to_numpy(), batch.column(3).is_valid().to_numpy(zero_copy_only=False)
            cuts = (np.flatnonzero((slices[1:] != slices[:-1]) | (there[1:] != there[:-1])) + 1).tolist()
            for a, b in zip([0, *cuts], [*cuts, len(slices)]):
                if a == b:
                    continue
                if now != slices[a]:
                    now, words, to = slices[a], [], None
                if not there[a]:  # no view of a batch is kept
                    words.append([batch.column(k).slice(a, b - a).to_numpy().copy() for k in (1, 2)])
                    continue
                if not words:
                    continue
                if to is None:
                    local, known = (np.concatenate(x) for x in zip(*words))
                    to = np.zeros(local.max() + 2, np.int64)  # the last is that of all others
                    to[local] = known
                for i in range(a, b):
                    ids = np.frombuffer(batch.column(3)[i].as_buffer(), np.int32)
                    held.append(windows(to[np.where(ids < len(to) - 1, ids, -1)]))
                    places += len(held[-1][0])
                    if places >= at_once:
                        yield from counted()
                        held, places = [], 0
                        pa.default_memory_pool().release_unused()
        if held:
            yield from counted()

    return coded.select("slice", "local", "id", "ids").mapInArrow(run, "hi long, lo long, n long")


def phrases_of(ranged: DataFrame, least: int) -> DataFrame:
    """(hi, lo, f) of the runs of two, three and four words in sorted ranges of keys: those of at
    least ``least``, and all at a range's ends, which may go on next to it."""

    def run(batches):
        open_: list[tuple[int, int, int, bool] | None] = [None] * (LONGEST - 1)  # of each length: key, count, whether it began the range
        began = [True] * (LONGEST - 1)
        for batch in batches:
            hi, lo, n = (batch.column(i).to_numpy() for i in range(3))
            if not len(hi):
                continue
            out = []
            for k, (low, there) in enumerate(((np.zeros_like(lo), np.ones(len(lo), bool)), (lo & ~_LOW, lo > 0), (lo, lo & _LOW > 0))):
                if not there.any():
                    continue
                h, x, c = hi[there], low[there], n[there]
                first = np.flatnonzero(np.concatenate([[True], (h[1:] != h[:-1]) | (x[1:] != x[:-1])]))
                h, x, c = h[first], x[first], np.add.reduceat(c, first)
                edge = np.zeros(len(h), bool)
                edge[0], began[k] = began[k], False
                if (was := open_[k]) and was[:2] == (h[0], x[0]):
                    c[0] += was[2]
                    edge[0] = was[3]
                elif was and (was[2] >= least or was[3]):
                    out.append(([was[0]], [was[1]], [was[2]]))
                open_[k] = (int(h[-1]), int(x[-1]), int(c[-1]), bool(edge[-1]))
                keep = np.flatnonzero((c[:-1] >= least) | edge[:-1])
                out.append((h[keep], x[keep], c[keep]))
            if out:
                yield pa.record_batch([pa.array(np.concatenate(x), pa.int64()) for x in zip(*out)], names=["hi", "lo", "f"])
        if last := [x for x in open_ if x]:
            yield pa.record_batch([pa.array([x[i] for x in last], pa.int64()) for i in range(3)], names=["hi", "lo", "f"])

    return ranged.mapInArrow(run, "hi long, lo long, f long")


def _parts(hi: str = "hi", lo: str = "lo") -> list[Column]:
    low = F.lit(_LOW)
    return [F.shiftrightunsigned(hi, 32), F.col(hi).bitwiseAND(low), F.shiftrightunsigned(lo, 32), F.col(lo).bitwiseAND(low)]


def _key(ids: list[Column]) -> tuple[Column, Column]:
    a, b, c, d = [*ids, *[F.lit(0).cast("long")] * LONGEST][:LONGEST]
    return F.shiftleft(a, 32).bitwiseOR(b), F.shiftleft(c, 32).bitwiseOR(d)


def collocations(docs: DataFrame, least: int = 30, top: int = 2000, text_col: str = "text", lang_col: str = "lang", slice_bytes: int = 8 << 20) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the ``top`` phrases of each lang by score descending, a
    descending, and phrase in the order of its bytes.

    A-Z are lower-cased, texts split at BREAKS into pieces and those at spaces and tabs into
    words. n counts all words of the lang. Phrases of two to four words that occur ``least``
    (at least 1) times or more within pieces, overlaps included, are candidates: a is a
    phrase's count, l and r those of its parts when it is cut after k words, and its score the
    smallest floor(2000000 a / (l + r)) of all cuts, of equal ones that of the smallest k. A
    candidate goes if a longer one holds it and 100 times the longer's count is at least 80
    times its own. Numbers are exact. Null texts are empty, a null lang is "und"; repeated rows
    count each; further columns are not read; an empty table, or one without frequent
    phrases, gives no row. More than 2**31 - 1 frequent words raise an error.
    """
    if least < 1:
        raise ValueError("least must be at least 1")
    staged = Staged(docs.sparkSession, "phrases")
    cut = staged.write(slices(docs, text_col, lang_col, slice_bytes), "slices")
    spots = cut.where(F.col("word").isNotNull()).drop("ids")
    counts = staged.write(spots.groupBy("lang", "word").agg(F.sum("n").alias("f")).select("lang", "word", "f", F.monotonically_increasing_id().alias("at")), "counts")
    totals = counts.groupBy("lang").agg(F.sum("f").alias("n"))
    # a number below 2**31 for each frequent word: its place in its partition of the table, interleaved
    frequent = counts.where(F.col("f") >= least)
    words = staged.write(frequent.select("lang", "word", "f", F.monotonically_increasing_id().alias("at")), "frequent")
    row, part = F.col("at").bitwiseAND((1 << 33) - 1), F.shiftrightunsigned("at", 33)
    parts = (words.agg(F.max(part)).first()[0] or 0) + 1
    words = words.select("lang", "word", "f", (row * parts + part + 1).alias("id"))
    if (words.agg(F.max("id")).first()[0] or 0) >= 1 << 31:
        raise ValueError("more frequent words than numbers of 31 bits")
    # each slice's frequent words, and then its ids
    known = spots.select("slice", "local", "lang", "word").join(words.select("lang", "word", "id"), ["lang", "word"]).select("slice", "local", "id", F.lit(None).cast("binary").alias("ids"))
    texts = cut.where(F.col("ids").isNotNull()).select("slice", "local", F.lit(None).cast("long").alias("id"), "ids")
    coded = known.unionByName(texts).repartition("slice").sortWithinPartitions("slice", F.col("ids").isNotNull())
    keys = staged.write(grams(coded), "keys")
    staged.drop("slices")
    ranges = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = keys.repartitionByRange(max(1, ranges), "hi", "lo").sortWithinPartitions("hi", "lo")
    found = staged.write(phrases_of(ranged, least).groupBy("hi", "lo").agg(F.sum("f").alias("a")).where(F.col("a") >= least), "phrases")
    staged.drop("keys")
    scored = staged.write(_scored(found, words), "scored")
    return _ranked(scored, words, totals, top)


def _scored(found: DataFrame, words: DataFrame) -> DataFrame:
    """(hi, lo, lang, a, l, r, score) of the phrases that no longer one takes the place of."""
    ids = _parts()
    zero = F.lit(0).cast("long")
    size = F.when(ids[2] == 0, 2).when(ids[3] == 0, 3).otherwise(4)
    pair = lambda part: F.struct(*[c.alias(n) for c, n in zip(_key(part), ("hi", "lo"))])
    # parts of every length; those over the end of a shorter phrase are taken out by k < size
    cuts = F.array(*[F.struct(F.lit(k).alias("k"), pair(ids[:k]).alias("first"), pair(ids[k:]).alias("rest")) for k in (1, 2, 3)])
    cut = found.select("hi", "lo", "a", F.explode(F.filter(cuts, lambda x: x["k"] < size)).alias("c")).select("hi", "lo", "a", "c.k", *[F.col(f"c.{p}.{x}").alias(f"{p}_{x}") for p in ("first", "rest") for x in ("hi", "lo")])
    one = words.select(F.shiftleft("id", 32).alias("hi"), zero.alias("lo"), F.col("f").alias("a"), "lang")
    every = one.unionByName(found.select("hi", "lo", "a", F.lit(None).cast("string").alias("lang")))
    for p, n in (("first", "l"), ("rest", "r")):
        cut = cut.join(every.select(F.col("hi").alias(f"{p}_hi"), F.col("lo").alias(f"{p}_lo"), F.col("a").alias(n), *([F.col("lang")] if p == "first" else [])), [f"{p}_hi", f"{p}_lo"])
    wide = lambda c: F.col(c).cast("decimal(20,0)")
    cut = cut.withColumn("num", wide("a") * F.lit(2000000).cast("decimal(7,0)")).withColumn("den", (wide("l") + wide("r")).cast("decimal(21,0)"))
    best = cut.groupBy("hi", "lo").agg(F.max("a").alias("a"), F.max("lang").alias("lang"), F.min(F.struct(F.expr("num div den").alias("score"), "k", "l", "r")).alias("b"))
    inner = [(2, 0, 2), (2, 1, 3), (3, 0, 3), (3, 1, 4), (2, 2, 4)]  # length, from, to
    subs = F.array(*[F.struct(F.lit(to).alias("to"), F.lit(n).alias("n"), pair(ids[i:to]).alias("key")) for n, i, to in inner])
    longer = found.where(ids[2] != 0).select("a", F.explode(F.filter(subs, lambda x: (x["to"] <= size) & (x["n"] < size))).alias("s")).groupBy(F.col("s.key.hi").alias("hi"), F.col("s.key.lo").alias("lo")).agg(F.max("a").alias("longer"))
    wide_of = lambda c, k: F.col(c).cast("decimal(20,0)") * F.lit(k).cast("decimal(3,0)")
    kept = best.join(longer, ["hi", "lo"], "left").where(F.col("longer").isNull() | (wide_of("longer", 100) < wide_of("a", 80)))
    return kept.select("hi", "lo", "lang", "a", "b.l", "b.r", F.col("b.score").cast("long").alias("score"))


def _ranked(scored: DataFrame, words: DataFrame, totals: DataFrame, top: int, deals: int = 32) -> DataFrame:
    """The first of each lang, spelled out. Phrases of a lang are dealt out by hash; of each
    deal the first ``top`` and their equals go on, so that one window has few rows."""
    dealt = Window.partitionBy("lang", F.pmod(F.xxhash64("hi", "lo"), F.lit(deals))).orderBy(F.desc("score"), F.desc("a"))
    first = scored.withColumn("place", F.rank().over(dealt)).where(F.col("place") <= top).drop("place")
    spots = first.select("*", F.posexplode(F.filter(F.array(*_parts()), lambda x: x != 0)).alias("at", "id"))
    spelled = spots.join(words.select("id", "word"), "id").groupBy("lang", "hi", "lo", "a", "l", "r", "score").agg(F.array_sort(F.collect_list(F.struct("at", "word"))).alias("w"))
    spelled = spelled.select("lang", "a", "l", "r", "score", F.array_join(F.transform("w", lambda x: x["word"].cast("string")), " ").alias("phrase"))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = spelled.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.join(totals, "lang").select("lang", F.col("rank").cast("long"), "phrase", "a", "l", "r", "n", "score")
