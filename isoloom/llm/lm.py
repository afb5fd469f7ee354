"""Language-model scores from a log-frequency Bloom filter.

The model is an interpolated bigram: p(w | h) = max(c(hw) - D, 0) / c(h)
+ a(h) p(w), with a(h) the share of h's occurrences that no stored bigram
explains, and p(w) the add-half unigram of the base score. All bigrams are
stored, their counts rounded down to a level (level 1 is a count of 1), in a Bloom filter that
holds (bigram, 1) .. (bigram, level): the count is found by probing level after
level until one is missing. Stored counts are never above the true ones but for
a false first probe (about one in a thousand), so probabilities of a history sum
to one but for that.

Words are known by 64-bit hashes. ``train`` counts over all training rows in
Spark. Filter and vocabulary are broadcast if they are below a stated size;
beyond it they are tables in shards. Texts are cut into slices; a slice's distinct
words and bigrams go to their shards as packed hashes, where the same filter is
probed, and counts and levels come back to the slice.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from isoloom.llm.common import Staged, batches_of, col, spare

#: No word is empty or a space: the end of a text, and what stands before its first word.
END, BEGIN = b"", b" "
DISCOUNT = 0.5
BASE = 1.5
BITS, PROBES, BLOCK = 14, 9, 1 << 20
#: Texts that a task works on at a time, in training and in scoring; a worker's memory grows with it.
SLICE, SCORED = 1024, 256
#: Bytes of the filter in a shard, where it is not broadcast.
SHARD_BYTES = 4 << 20
_P, _Q = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def _mix(x: np.ndarray, y) -> np.ndarray:
    z = x * _P ^ (np.uint64(y * int(_Q) & 0xFFFFFFFFFFFFFFFF) if isinstance(y, int) else y * _Q)
    z ^= z >> np.uint64(32)
    z *= _P
    return z ^ z >> np.uint64(29)


def levels(n: np.ndarray) -> np.ndarray:
    return np.where(n < 2, 1, 2 + np.floor(np.log(np.maximum(n, 2) / 2) / np.log(BASE) + 1e-9).astype(np.int64))


def counts_of(level: np.ndarray) -> np.ndarray:
    """The counts that levels stand for, rounded down; 0 for level 0."""
    return np.where(level > 1, 2 * BASE ** (np.maximum(level, 2) - 2.0), np.where(level > 0, 1.0, 0.0))


class Tokens:
    """Tokens of the texts of an Arrow column: cur and prev index the distinct words' hashes."""

    def __init__(self, texts: pa.Array):
        # Arrow's ASCII blanks are those of the word rule; it gives empty words at the ends
        lists = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts.cast(pa.string()), "")))
        flat = lists.flatten()
        there = pc.greater(pc.binary_length(flat), 0)
        ends = np.concatenate(([0], np.cumsum(there.to_numpy(zero_copy_only=False))))[np.cumsum(pc.list_value_length(lists).to_numpy(), dtype=np.int64)]
        coded = flat.filter(there).dictionary_encode()
        self.cur = np.insert(coded.indices.to_numpy().astype(np.int64) + 2, ends, 1)
        known = pc.binary_join(pa.ListArray.from_arrays([0, len(coded.dictionary)], coded.dictionary), "")[0].as_py().encode("utf-8")
        cut = [0, *np.cumsum(pc.binary_length(coded.dictionary).to_numpy(), dtype=np.int64).tolist()]
        hashes = [xxhash.xxh3_64_intdigest(x) for x in (BEGIN, END)] + [xxhash.xxh3_64_intdigest(known[a:b]) for a, b in zip(cut, cut[1:])]
        self.hash = np.array(hashes, np.uint64)
        ends = ends + np.arange(1, len(ends) + 1)
        self.first = np.concatenate(([0], ends[:-1])).astype(np.int64)
        self.size = ends - self.first
        self.prev = np.concatenate(([0], self.cur[:-1]))
        self.prev[self.first] = 0

    def pairs(self):
        """Distinct (prev, cur) as indices, with their places and counts."""
        key, back, n = np.unique(self.prev * len(self.hash) + self.cur, return_inverse=True, return_counts=True)
        return key // len(self.hash), key % len(self.hash), back, n


def _parts(batches, rows: int):
    for batch in batches:
        for i in range(0, batch.num_rows, rows):
            yield batch.slice(i, rows)


@dataclass
class Tables:
    """vocabulary (w, c, rest): count of each word and a(w), and how many texts BEGIN stands
    before; pairs (g, n): bigrams with their counts."""

    vocabulary: DataFrame
    pairs: DataFrame
    n_tokens: int
    n_words: int
    n_grams: int
    n_entries: int
    n_texts: int
    staged: Staged | None = None

    def drop(self, name: str) -> None:
        """Deletes a written table, "bigrams" or "words", when what is made of it is there."""
        if self.staged and name in self.staged.paths:
            self.staged.drop(name)

    @property
    def grams(self) -> DataFrame:
        """(g, level) of every bigram."""
        return self.pairs.groupBy("g").agg(F.sum("n").alias("n")).select("g", _level().alias("level"))


def train(texts: DataFrame, text_col: str = "text", staged: Staged | None = None) -> Tables:
    """Counts words and bigrams of all rows; a null text is an empty one.

    Every word is followed by one token, so words are counted as first words of
    bigrams, and texts by their ends. The counted bigrams are written once, for the
    words' sums and for the filter.
    """
    staged = staged or Staged(texts.sparkSession, "lm")
    texts = texts.select(F.col(text_col).cast("string").alias("text"))

    def two(batches):
        for part in _parts(batches, SLICE):
            t = Tokens(part.column(0))
            h, w, _, n = t.pairs()
            yield pa.record_batch([pa.array(t.hash[h].view(np.int64)), pa.array(_mix(t.hash[h], t.hash[w]).view(np.int64)), pa.array(n.astype(np.int64))], names=["h", "g", "n"])
            del t, h, w, n
            pa.default_memory_pool().release_unused()

    pairs = texts.mapInArrow(two, "h long, g long, n long")
    # in order of h, which then takes hardly any room
    with batches_of(texts.sparkSession, SLICE):
        pairs = staged.write(pairs.groupBy("h", "g").agg(F.sum("n").alias("n")).sortWithinPartitions("h"), "bigrams")
    counted = pairs.select("h", "n", _level().alias("level")).groupBy("h").agg(F.sum("n").alias("c"), F.sum(_stored() - DISCOUNT).alias("explained"), F.count("*").alias("n_grams"), F.sum("level").alias("n_entries"))
    vocabulary = staged.write(counted.select(F.col("h").alias("w"), "c", F.greatest(F.lit(0.0), 1 - F.col("explained") / F.col("c")).alias("rest"), "n_grams", "n_entries"), "words")
    first = vocabulary.where(F.col("w") == _hash_of(BEGIN)).agg(F.sum("c")).first()[0] or 0
    row = vocabulary.agg(F.sum("c"), F.count("*"), F.sum("n_grams"), F.sum("n_entries")).first()
    end = texts.sparkSession.createDataFrame([(_hash_of(END), first, 1.0)] if first else [], "w long, c long, rest double")
    # as many ends as beginnings, and BEGIN is no token
    return Tables(vocabulary.select("w", "c", "rest").unionByName(end), pairs.select("g", "n"), row[0] or 0, row[1], row[2] or 0, row[3] or 0, first, staged)


def _level():
    """levels() of a column n."""
    return F.when(F.col("n") < 2, 1).otherwise(F.floor(F.log(F.col("n") / 2) / F.log(F.lit(BASE)) + 1e-9) + 2).cast("int")


def _stored():
    """counts_of() of a stored bigram's level, as a column."""
    return F.when(F.col("level") > 1, F.lit(2.0) * F.pow(F.lit(BASE), F.col("level") - 2.0)).otherwise(F.lit(1.0))


def _hash_of(word: bytes) -> int:
    return int(np.uint64(xxhash.xxh3_64_intdigest(word)).view(np.int64))


def _probe_places(g: np.ndarray, level: int) -> tuple[np.ndarray, np.ndarray]:
    z = _mix(g, level)
    return z & np.uint64(BLOCK - 1), z >> np.uint64(32) | np.uint64(1)


class CountFilter:
    """The filter: blocks of BLOCK bits, each for the bigrams of its hash range."""

    def __init__(self, blocks: np.ndarray):
        self.blocks = blocks  # (number of blocks, BLOCK / 8) bytes

    @staticmethod
    def block_of(g: np.ndarray, n: int) -> np.ndarray:
        return (g >> np.uint64(40)) % np.uint64(n)

    @staticmethod
    def build(g: np.ndarray, level: np.ndarray) -> bytes:
        bits = np.zeros(BLOCK, np.uint8)
        for k in range(1, int(level.max(initial=0)) + 1):
            a, b = _probe_places(g[level >= k], k)
            for i in range(PROBES):
                bits[(a + np.uint64(i) * b) & np.uint64(BLOCK - 1)] = 1
        return np.packbits(bits, bitorder="little").tobytes()

    def level(self, g: np.ndarray, block: np.ndarray | None = None) -> np.ndarray:
        """Highest level whose probes, and those of all below, are present. ``block``: the rows of
        blocks to probe, where these are not the whole filter."""
        out = np.zeros(len(g), np.int64)
        if not len(self.blocks):
            return out
        flat, size = self.blocks.reshape(-1), np.uint64(BLOCK // 8)
        at = np.arange(len(g))
        base = (self.block_of(g, len(self.blocks)) if block is None else block) * size
        k = 0
        while len(at):
            k += 1
            a, b = _probe_places(g[at], k)
            here = base[at]
            for i in range(PROBES):
                bit = (a + np.uint64(i) * b) & np.uint64(BLOCK - 1)
                ok = (flat[here + (bit >> np.uint64(3))] >> (bit & np.uint64(7)).astype(np.uint8)) & 1 > 0
                at, a, b, here = at[ok], a[ok], b[ok], here[ok]
            out[at] = k
        return out


def filter_blocks(tables: Tables) -> tuple[int, DataFrame]:
    """The filter's number of blocks, about BLOCK / BITS entries each, and rows (block, bits) of those with entries."""
    n = -(-tables.n_entries * BITS // BLOCK)

    def block(key, table):
        g = table.column("g").to_numpy().view(np.uint64)
        bits = CountFilter.build(g, table.column("level").to_numpy())
        return pa.table({"block": pa.array([key[0].as_py()], pa.int64()), "bits": pa.array([bits], pa.binary())})

    return n, tables.pairs.select(_block_number(n), "g", _level().alias("level")).groupBy("block").applyInArrow(block, "block long, bits binary")


def _block_number(n: int):
    return F.pmod(F.shiftrightunsigned("g", 40), F.lit(max(1, n))).alias("block")


def build_filter(tables: Tables) -> CountFilter:
    """The whole filter in memory; its blocks are built in Spark."""
    n, blocks = filter_blocks(tables)
    out = np.zeros((n, BLOCK // 8), np.uint8)
    if n:
        staged = Staged(tables.pairs.sparkSession, "filter")
        written = staged.write(blocks, "blocks")
        for row in written.toLocalIterator():  # the driver holds the filter, and no second copy of it
            out[row["block"]] = np.frombuffer(row["bits"], np.uint8)
        staged.drop("blocks")
    return CountFilter(out)


SCORES = "n_tokens long, n_known long, base_score double, score double"


def score(docs: DataFrame, tables: Tables, text_col: str = "text", broadcast_bytes: int = 32 << 20, last: bool = False, slice_bytes: int = 8 << 20) -> DataFrame:
    """Adds n_tokens, n_known, base_score and score to every row, on its whole text.

    Words and one end are tokens; A-Z are lower-cased. A null or empty text is its
    end alone. Equal texts score alike; an empty table stays empty. Without
    training tokens every token has the probability that counts of 0 give. ``last``:
    no more texts are scored by these tables, so what is written of them is deleted
    when the filter is built. ``slice_bytes``: of text whose words are looked up together.
    """
    if clash := {"n_tokens", "n_known", "base_score", "score"} & set(docs.columns):
        raise ValueError(f"{sorted(clash)} are columns already")
    need = 24 * (tables.n_words + 1) + tables.n_entries * BITS // 8
    if need <= broadcast_bytes:
        return _by_broadcast(docs, tables, text_col, last)
    return _by_lookup(docs, tables, text_col, last, slice_bytes)


def _by_broadcast(docs: DataFrame, tables: Tables, text_col: str, last: bool) -> DataFrame:
    spark = docs.sparkSession
    blocks = build_filter(tables).blocks
    if last:
        tables.drop("bigrams")
    got = tables.vocabulary.toArrow()
    order = np.argsort(got.column("w").to_numpy().view(np.uint64))
    sorted_ = [got.column(c).to_numpy()[order] for c in ("w", "c", "rest")]
    del got, order
    known = spark.sparkContext.broadcast((sorted_[0].view(np.uint64), *sorted_[1:], blocks))
    del sorted_, blocks
    total = tables.n_tokens + 0.5 * (tables.n_words + 1)
    begin = np.int64(_hash_of(BEGIN)).view(np.uint64)

    @F.arrow_udf(SCORES)
    def run(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        hashes, count, rest, blocks = known.value
        grams = CountFilter(blocks)
        for array in texts:
            parts = [_score(Tokens(array.slice(i, SCORED)), hashes, count, rest, grams, total, begin) for i in range(0, len(array), SCORED)]
            table = pd.concat(parts, ignore_index=True) if parts else pd.DataFrame({c: pd.Series([], dtype=t) for c, t in zip(("n_tokens", "n_known", "base_score", "score"), ("int64", "int64", "float64", "float64"))})
            yield pa.StructArray.from_arrays([pa.array(table[c]) for c in table.columns], names=list(table.columns))
            pa.default_memory_pool().release_unused()

    into = spare(docs, "lm")
    return docs.withColumn(into, run(F.col(text_col).cast("string"))).select(*[col(c) for c in docs.columns], f"{into}.*")


def _score(t: Tokens, hashes, count, rest, grams: CountFilter, total: float, begin) -> pd.DataFrame:
    c, a = _known(t.hash, hashes, count, rest)
    h, w, back, _ = t.pairs()
    level = np.zeros(len(h), np.int64)
    may = np.flatnonzero((c[h] >= 1) & (c[w] >= 1))
    level[may] = grams.level(_mix(t.hash[h[may]], t.hash[w[may]]))
    return pd.DataFrame(_sums(t, c, a, h, w, back, level, total, begin))


def _sums(t: Tokens, c, a, h, w, back, level, total: float, begin) -> dict[str, np.ndarray]:
    """The new columns of t's texts, from count c and a(w) of its words and the levels of its pairs (h, w)."""
    uni = (np.where(t.hash == begin, 0, c) + 0.5) / total
    p = token_probability(level, c[h], a[h], uni[w])
    logs = np.log10(p)[back]
    base = np.log10(uni)[t.cur]
    return {"n_tokens": t.size, "n_known": np.add.reduceat((c[t.cur] > 0).astype(np.int64), t.first), "base_score": np.add.reduceat(base, t.first), "score": np.add.reduceat(logs, t.first)}


def token_probability(level, before, rest, uni):
    """p(w | h) from the bigram's level, c(h), a(h) and p(w)."""
    c = counts_of(level)
    found = (level > 0) & (c <= before)
    return np.where(before > 0, np.where(found, (c - DISCOUNT) / np.maximum(before, 1), 0.0) + rest * uni, uni).clip(1e-300, 1.0)


def _slice_of(text, slice_bytes: int):
    """Numbers of slices of about ``slice_bytes`` of a partition's texts, a row counting 16 bytes more."""

    @F.arrow_udf("long")
    def number(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        at, before = TaskContext.get().partitionId() << 32, 0
        for array in texts:
            size = pc.fill_null(pc.binary_length(array), 0).to_numpy(zero_copy_only=False).astype(np.int64) + 16
            ends = before + np.cumsum(size)
            yield pa.array(at + (ends - size) // slice_bytes)
            before = int(ends[-1]) if len(ends) else before

    return number(text)


def _runs(batches) -> Iterator[tuple[int, int, pa.Array]]:
    """(slice, first id, texts) of rows (slice, id, text) with one id after the other in the same slice."""
    held, slice_, first, after = [], None, None, None
    for batch in batches:
        s, i = (batch.column(k).to_numpy() for k in (0, 1))
        cuts = (np.flatnonzero((s[1:] != s[:-1]) | (i[1:] != i[:-1] + 1)) + 1).tolist()
        for a, b in zip([0, *cuts], [*cuts, len(i)]):
            if a == b:
                continue
            if (slice_, after) != (s[a], i[a]):
                if held:
                    yield slice_, first, pa.concat_arrays(held)
                held, slice_, first = [], int(s[a]), int(i[a])
            held.append(batch.column(2).slice(a, b - a))
            after = int(i[b - 1]) + 1
    if held:
        yield slice_, first, pa.concat_arrays(held)


class _Shards:
    """Where bigrams and words are looked up: a filter of n blocks in shards, as many in each."""

    def __init__(self, n_blocks: int, partitions: int):
        self.n_blocks = max(1, n_blocks)
        self.n = max(1, partitions, -(-n_blocks * (BLOCK // 8) // SHARD_BYTES))

    def of_block(self, block):
        return block % np.uint64(self.n)

    def of_gram(self, g: np.ndarray) -> np.ndarray:
        return self.of_block(CountFilter.block_of(g, self.n_blocks))

    def of_word(self, w: np.ndarray) -> np.ndarray:
        return (w >> np.uint64(40)) % np.uint64(self.n)

    def dealt(self, shard: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Order by shard, and where each shard's part ends."""
        return np.argsort(shard, kind="stable"), np.cumsum(np.bincount(shard.astype(np.int64), minlength=self.n))


def _model(tables: Tables, shards: _Shards, blocks: DataFrame) -> DataFrame:
    """(shard, block, a, b, c): the filter's blocks with their bits in a, and at block -1 the shard's words, counts and shares."""

    def words(key, table):
        order = np.argsort(table.column("w").to_numpy().view(np.uint64))
        packed = [pa.array([table.column(x).to_numpy()[order].tobytes()], pa.binary()) for x in ("w", "c", "rest")]
        return pa.table([pa.array([key[0].as_py()], pa.int64()), pa.array([-1], pa.int64()), *packed], names=["shard", "block", "a", "b", "c"])

    n, none = shards.n, F.lit(None).cast("binary")
    vocabulary = tables.vocabulary.withColumn("shard", F.shiftrightunsigned("w", 40) % n)
    packed = vocabulary.groupBy("shard").applyInArrow(words, "shard long, block long, a binary, b binary, c binary")
    return packed.unionByName(blocks.select((F.col("block") % n).alias("shard"), "block", F.col("bits").alias("a"), none.alias("b"), none.alias("c")))


def _asked(rows: DataFrame, shards: _Shards) -> DataFrame:
    """(shard, slice, first, a, b): the distinct bigrams and words of each run of rows (slice, id, text), packed by shard."""

    def run(batches):
        for slice_, first, texts in _runs(batches):
            t = Tokens(texts)
            key = np.unique(t.prev * len(t.hash) + t.cur)
            parts = []
            for found, shard in ((g := _mix(t.hash[key // len(t.hash)], t.hash[key % len(t.hash)]), shards.of_gram(g)), (t.hash, shards.of_word(t.hash))):
                order, ends = shards.dealt(shard)
                cut, ends = found[order].tobytes(), (8 * ends).tolist()
                parts.append([cut[x:y] for x, y in zip([0, *ends], ends)])
            there = [k for k in range(shards.n) if parts[0][k] or parts[1][k]]
            columns = [pa.array(there, pa.int64()), pa.array([slice_] * len(there), pa.int64()), pa.array([first] * len(there), pa.int64()), *[pa.array([x[k] for k in there], pa.binary()) for x in parts]]
            yield pa.record_batch(columns, names=["shard", "slice", "first", "a", "b"])
            del t, key, parts, columns, g, texts
            pa.default_memory_pool().release_unused()

    return rows.mapInArrow(run, "shard long, slice long, first long, a binary, b binary")


def _answered(model: DataFrame, asked: DataFrame, shards: _Shards) -> DataFrame:
    """(slice, first, shard, levels, counts, rests) of what was asked, in its order. A shard's model comes before the questions to it."""

    def run(batches):
        now, blocks, words = None, None, None
        for batch in batches:
            shard, block = (batch.column(k).to_numpy(zero_copy_only=False) for k in (0, 1))
            a, b, c = (batch.column(k) for k in (4, 5, 6))
            of = lambda x, i, kind: np.frombuffer(x[i].as_buffer(), kind)
            cuts = (np.flatnonzero(shard[1:] != shard[:-1]) + 1).tolist()
            for x, y in zip([0, *cuts], [*cuts, len(shard)]):
                if x == y:
                    continue
                if now != shard[x]:
                    now = int(shard[x])
                    blocks = np.zeros((max(0, -(-(shards.n_blocks - now) // shards.n)), BLOCK // 8), np.uint8)
                    words = [np.zeros(0, kind) for kind in (np.uint64, np.int64, np.float64)]
                asked = []
                for i in range(x, y):
                    if block[i] >= 0:
                        blocks[int(block[i]) // shards.n] = of(a, i, np.uint8)
                    elif block[i] == -1:
                        words = [of(p, i, kind).copy() for p, kind in zip((a, b, c), (np.uint64, np.int64, np.float64))]
                    else:
                        asked.append(i)
                if not asked:
                    continue
                grams, wanted = ([of(p, i, np.uint64) for i in asked] for p in (a, b))
                ends = [np.cumsum([len(p) for p in q]) for q in (grams, wanted)]
                g, w = np.concatenate(grams), np.concatenate(wanted)
                level = CountFilter(blocks).level(g, CountFilter.block_of(g, shards.n_blocks) // np.uint64(shards.n)).astype(np.int16)
                count, rest = _known(w, *words)
                columns = [batch.column(2).take(pa.array(asked)), batch.column(3).take(pa.array(asked)), pa.array([now] * len(asked), pa.int64())]
                columns += [pa.array([v[p:q].tobytes() for p, q in zip([0, *e[:-1]], e)], pa.binary()) for v, e in ((level, ends[0]), (count, ends[1]), (rest, ends[1]))]
                yield pa.record_batch(columns, names=["slice", "first", "shard", "levels", "counts", "rests"])

    none = F.lit(None).cast("long")
    parts = model.select("shard", "block", none.alias("slice"), none.alias("first"), "a", "b", "c")
    questions = asked.select("shard", F.lit(-2).cast("long").alias("block"), "slice", "first", "a", "b", F.lit(None).cast("binary").alias("c"))
    together = parts.unionByName(questions).repartition("shard").sortWithinPartitions("shard", F.desc("block"))
    return together.mapInArrow(run, "slice long, first long, shard long, levels binary, counts binary, rests binary")


def _known(w: np.ndarray, hashes: np.ndarray, count: np.ndarray, rest: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Counts and shares of words, 0 and 1.0 for those that are not in the sorted hashes."""
    if not len(hashes):
        return np.zeros(len(w), np.int64), np.ones(len(w))
    at = np.minimum(np.searchsorted(hashes, w), len(hashes) - 1)
    there = hashes[at] == w
    return np.where(there, count[at], 0), np.where(there, rest[at], 1.0)


def _by_lookup(docs: DataFrame, tables: Tables, text_col: str, last: bool, slice_bytes: int) -> DataFrame:
    """The same scores for tables too large to broadcast. Rows are written with the numbers of
    their slices; what a slice asks and the rows of the slice meet again in one task."""
    names, id_ = docs.columns, spare(docs, "row")
    slice_ = spare(docs, "slice")
    spark, total, begin = docs.sparkSession, tables.n_tokens + 0.5 * (tables.n_words + 1), np.uint64(_hash_of(BEGIN) & 0xFFFFFFFFFFFFFFFF)
    staged = Staged(spark, "lm-rows")
    n_blocks, blocks = filter_blocks(tables)
    shards = _Shards(n_blocks, int(spark.conf.get("spark.sql.shuffle.partitions")))
    model = staged.write(_model(tables, shards, blocks), "model")
    if last:
        tables.drop("bigrams")
        tables.drop("words")
    rows = staged.write(docs.withColumns({id_: F.monotonically_increasing_id(), slice_: _slice_of(F.col(text_col).cast("string"), slice_bytes)}), "rows")
    texts = rows.select(F.col(slice_).alias("slice"), F.col(id_).alias("id"), F.col(text_col).cast("string").alias("text"))

    def scored(ids: list[int], texts: list[pa.Array], answers: dict[int, list]) -> Iterator[pa.RecordBatch]:
        texts, firsts = pa.concat_arrays(texts), sorted(answers)
        cuts = np.searchsorted(ids, firsts).tolist()
        for first, a, b in zip(firsts, cuts, [*cuts[1:], len(ids)]):
            t = Tokens(texts.slice(a, b - a))
            h, w, back, _ = t.pairs()
            g = _mix(t.hash[h], t.hash[w])
            found = [np.zeros(len(g), np.int16), np.zeros(len(t.hash), np.int64), np.ones(len(t.hash))]
            (of_g, end_g), (of_w, end_w) = shards.dealt(shards.of_gram(g)), shards.dealt(shards.of_word(t.hash))
            for shard, *parts in answers[first]:
                for into, order, ends, part in zip(found, (of_g, of_w, of_w), (end_g, end_w, end_w), parts):
                    into[order[ends[shard - 1] if shard else 0 : ends[shard]]] = np.frombuffer(part, into.dtype)
            level, c, rest = found
            sums = _sums(t, c, rest, h, w, back, np.where((c[h] >= 1) & (c[w] >= 1), level, 0).astype(np.int64), total, begin)
            yield pa.record_batch([pa.array(ids[a:b], pa.int64()), *[pa.array(x) for x in sums.values()]], names=["id", *sums])
            del t, h, w, back, g, found, level, c, rest, sums
            pa.default_memory_pool().release_unused()

    def run(batches):
        now, ids, held, answers = None, [], [], {}
        for batch in batches:
            slices, id_ = (batch.column(k).to_numpy() for k in (0, 1))
            shard = batch.column(2).to_numpy(zero_copy_only=False)
            cuts = (np.flatnonzero((slices[1:] != slices[:-1]) | ((shard[1:] < 0) != (shard[:-1] < 0))) + 1).tolist()
            for a, b in zip([0, *cuts], [*cuts, len(id_)]):
                if a == b:
                    continue
                if now != slices[a]:
                    if ids:
                        yield from scored(ids, held, answers)
                    now, ids, held, answers = int(slices[a]), [], [], {}
                if shard[a] < 0:
                    ids += id_[a:b].tolist()
                    held.append(batch.column(3).slice(a, b - a))
                else:
                    for i in range(a, b):
                        answers.setdefault(int(id_[i]), []).append((int(shard[i]), *[batch.column(k)[i].as_py() for k in (4, 5, 6)]))
        if ids:
            yield from scored(ids, held, answers)

    none = F.lit(None).cast("binary")
    with batches_of(spark, 64):
        answers = staged.write(_answered(model, _asked(texts, shards), shards), "answers")
        staged.drop("model")
        asked = answers.select("slice", F.col("first").alias("id"), "shard", F.lit(None).cast("string").alias("text"), "levels", "counts", "rests")
        told = texts.select("slice", "id", F.lit(-1).cast("long").alias("shard"), "text", none.alias("levels"), none.alias("counts"), none.alias("rests"))
        together = asked.unionByName(told).repartition("slice").sortWithinPartitions("slice", F.col("shard") < 0, "id")
        sums = staged.write(together.mapInArrow(run, f"id long, {SCORES}"), "sums")
        staged.drop("answers")
    return rows.join(sums.withColumnRenamed("id", id_), id_).select(*[col(c) for c in names], "n_tokens", "n_known", "base_score", "score")
