"""Token ids in files of Huffman-coded blocks.

A file set is two Parquet tables, so Spark's writers commit it and any file
system holds it: ``code`` (symbol, bits) has the lengths of the canonical code,
which fix the code words; ``blocks`` has a row for each block of whole documents:

  part, block      place; parts and blocks ascend with doc_id
  token_start      ids of this part before the block
  doc_ids, doc_tokens   the block's documents and how many ids each has
  marks            bit offset of every MARK-th id, unsigned 32-bit
  bits             the code words, first bit highest

A block is decoded alone, and its marks let all stretches between them be
decoded side by side with one table look-up an id.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from isoloom.llm.common import Staged
from isoloom.llm.tokens import binary_slices, encode_parts, with_end

MARK = 128
#: Longest code word, unless so many ids occur that it has to be longer.
LONGEST = 16
BLOCKS = "part int, block int, token_start long, doc_ids array<long>, doc_tokens array<long>, marks binary, bits binary"
STORED = "doc_id long, crc long, wide boolean, ids binary"
TOKENS = "doc_id long, part int, at long, n_tokens long, ids binary"


def encode(docs: DataFrame, tokenizer: str, end_id: int | None = None, id_col: str = "doc_id", text_col: str = "text", stored: bool = False) -> DataFrame:
    """(doc_id, ids): little-endian unsigned 32-bit ids of every whole text, then end_id.
    A null text is encoded as an empty one. With ``stored``, rows are as write_tokens keeps
    them, (doc_id, crc, wide, ids), and need no further pass there."""

    def run(batches):
        for batch in batches:
            for row, ids, ends in encode_parts(batch.column(1), tokenizer):
                ids, ends = with_end(ids, ends, end_id)
                doc = batch.column(0).slice(row, len(ends)).cast(pa.int64())
                if not stored:
                    yield pa.record_batch([doc, binary_slices(ids, ends)], names=["doc_id", "ids"])
                    continue
                wide = len(ids) > 0 and int(ids.max()) > 0xFFFF
                raw = memoryview(np.ascontiguousarray(ids, "<u4")).cast("B")
                crc = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip([0, *ends[:-1].tolist()], ends.tolist())]
                yield pa.record_batch([doc, pa.array(crc, pa.int64()), pa.array([wide] * len(ends), pa.bool_()), binary_slices(ids if wide else ids.astype("<u2"), ends)], names=["doc_id", "crc", "wide", "ids"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, STORED if stored else "doc_id long, ids binary")


def code_lengths(counts: np.ndarray, longest: int = LONGEST) -> np.ndarray:
    """Lengths of the best prefix code with no word over ``longest`` bits (package-merge).
    More ids than such words exist get two bits over the least that they need; 0 for ids
    that do not occur."""
    used = np.flatnonzero(counts)
    out = np.zeros(len(counts), np.int64)
    if len(used) > 1 << longest:
        longest = int(len(used) - 1).bit_length() + 2
    if len(used) < 2:
        out[used] = 1
        return out
    order = used[np.argsort(counts[used], kind="stable")]
    weights = counts[order].astype(np.float64)
    leaves, level = [], np.zeros(0)
    for _ in range(longest):
        both = np.concatenate((weights, level))
        by = np.argsort(both, kind="stable")
        leaves.append(by < len(weights))
        both = both[by]
        level = both[: len(both) // 2 * 2].reshape(-1, 2).sum(1)
    take = 2 * len(weights) - 2
    for leaf in reversed(leaves):
        n = int(leaf[:take].sum())
        out[order[:n]] += 1
        take = 2 * (take - n)
    return out


def code_words(lengths: np.ndarray) -> np.ndarray:
    """Canonical words: by length, then by id."""
    words = np.zeros(len(lengths), np.uint32)
    word = last = 0
    for i in np.lexsort((np.arange(len(lengths)), lengths)):
        n = int(lengths[i])
        if n:
            word <<= n - last
            words[i] = word
            word, last = word + 1, n
    return words


def pack_block(ids: np.ndarray, lengths: np.ndarray, words: np.ndarray) -> tuple[bytes, bytes]:
    """(marks, bits) of some ids."""
    size = lengths[ids]
    ends = np.cumsum(size)
    start = ends - size
    at = start >> 5
    # a word lies in at most two units of 32 bits; no two share a bit, so sums are exact
    both = words[ids].astype(np.uint64) << (64 - (start & 31) - size).astype(np.uint64)
    units = np.bincount(at, (both >> np.uint64(32)).astype(np.float64), (int(ends[-1]) + 63) // 32 if len(ends) else 0)
    units += np.bincount(at + 1, (both & np.uint64(0xFFFFFFFF)).astype(np.float64), len(units))[: len(units)]
    bits = units.astype(np.uint64).astype(">u4").tobytes()
    return start[::MARK].astype("<u4").tobytes(), bits[: (int(ends[-1]) + 7) // 8 if len(ends) else 0]


def tables(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """(id, bits) for each value of the next bits, as many as the longest word has, and their number."""
    longest = int(lengths.max(initial=1))
    words = code_words(lengths)
    used = np.flatnonzero(lengths)
    used = used[np.argsort(words[used].astype(np.int64) << (longest - lengths[used]))]
    each = np.int64(1) << (longest - lengths[used])
    symbol, bits = np.zeros(1 << longest, np.uint32), np.ones(1 << longest, np.int64)
    symbol[: each.sum()], bits[: each.sum()] = np.repeat(used, each), np.repeat(lengths[used], each)
    return symbol, bits, longest


def unpack_block(marks: bytes, bits: bytes, n: int, symbol: np.ndarray, length: np.ndarray, longest: int) -> np.ndarray:
    at = np.frombuffer(marks, "<u4").astype(np.int64)
    raw = np.frombuffer(bits + b"\0\0\0\0", np.uint8).astype(np.uint32)
    four = raw[:-3] << 24 | raw[1:-2] << 16 | raw[2:-1] << 8 | raw[3:]
    out = np.zeros((MARK, len(at)), np.uint32)
    last, mask = len(four) - 1, np.uint32((1 << longest) - 1)
    for k in range(min(MARK, n)):
        peek = four[np.minimum(at >> 3, last)] >> (32 - longest - (at & 7)).astype(np.uint32) & mask
        out[k] = symbol[peek]
        at = at + length[peek]
    return out.T.reshape(-1)[:n]


def _narrow(tokens: DataFrame) -> DataFrame:
    """(doc_id, crc, wide, ids): ids in 16 bits where they fit all of a row, else in 32."""

    def run(batches):
        for batch in batches:
            for i in range(0, batch.num_rows, 512):
                part = batch.slice(i, 512)
                wide, crc, out = [], [], []
                for x in part.column(1):
                    raw = x.as_buffer() or b""
                    ids = np.frombuffer(raw, "<u4")
                    wide.append(bool(len(ids)) and int(ids.max()) > 0xFFFF)
                    crc.append(zlib.crc32(raw))
                    out.append(bytes(raw) if wide[-1] else ids.astype("<u2").tobytes())
                yield pa.record_batch([part.column(0), pa.array(crc, pa.int64()), pa.array(wide), pa.array(out, pa.binary())], names=["doc_id", "crc", "wide", "ids"])

    return tokens.select("doc_id", "ids").mapInArrow(run, STORED)


def _joined(wide: pa.Array, ids: pa.Array) -> np.ndarray:
    """Ids of rows of _narrow one after the other."""
    parts = ids.to_pylist()
    if not pc.any(wide).as_py():
        return np.frombuffer(b"".join(parts), "<u2").astype(np.uint32)
    return np.concatenate([np.frombuffer(x, "<u4" if w else "<u2").astype(np.uint32) for w, x in zip(wide.to_pylist(), parts)])


def write_tokens(tokens: DataFrame, path: str, block_tokens: int = 1 << 16) -> None:
    """Writes (doc_id, ids), or encode(stored=True), in ascending doc_id order as a file set at path.

    Rows with null doc_id come first; rows of one doc_id follow each other. A
    row without ids is kept. A document longer than a block has one of its own.
    An empty table gives files without blocks.
    """
    spark = tokens.sparkSession
    staged = Staged(spark, "token-files")
    tokens = staged.write(tokens if {"crc", "wide"} <= set(tokens.columns) else _narrow(tokens), "ids")

    def count(batches):
        total = np.zeros(0, np.int64)
        for batch in batches:
            for i in range(0, batch.num_rows, 4096):
                part = batch.slice(i, 4096)
                got = np.bincount(_joined(*part.columns), minlength=len(total))
                got[: len(total)] += total
                total = got
        at = np.flatnonzero(total)
        yield pa.record_batch([pa.array(at, pa.int64()), pa.array(total[at], pa.int64())], names=["symbol", "n"])

    found = tokens.select("wide", "ids").mapInArrow(count, "symbol long, n long").groupBy("symbol").agg(F.sum("n").alias("n")).collect()
    counts = np.zeros(max((r.symbol for r in found), default=0) + 1, np.int64)
    for r in found:
        counts[r.symbol] = r.n
    lengths = code_lengths(counts)
    code = [(int(i), int(lengths[i])) for i in np.flatnonzero(lengths)]
    spark.createDataFrame(code, "symbol long, bits int").coalesce(1).write.parquet(f"{path}/code")

    def blocks(batches):
        words = code_words(lengths)
        part, block, start = TaskContext.get().partitionId(), 0, 0
        held, size = [], 0

        def one():
            n = [len(x) for _, x in held]
            marks, bits = pack_block(np.concatenate([x for _, x in held]), lengths, words)
            row = {"part": part, "block": block, "token_start": start, "doc_ids": [d for d, _ in held], "doc_tokens": n, "marks": marks, "bits": bits}
            return pa.RecordBatch.from_pylist([row], schema=_BLOCKS)

        for batch in batches:
            for d, wide, x in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                held.append((d, np.frombuffer(x.as_py(), "<u4" if wide else "<u2")))
                size += len(held[-1][1])
                if size >= block_tokens or len(held) >= block_tokens:
                    yield one()
                    block, start, held, size = block + 1, start + size, [], 0
        if held:
            yield one()

    # equal ids are no hot key: their rows are told apart by what they hold
    ordered = tokens.repartitionByRange("doc_id", "crc").sortWithinPartitions("doc_id", "crc", "ids").select("doc_id", "wide", "ids")
    ordered.mapInArrow(blocks, BLOCKS).write.option("compression", "uncompressed").parquet(f"{path}/blocks")
    staged.drop("ids")


_BLOCKS = pa.schema([("part", pa.int32()), ("block", pa.int32()), ("token_start", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("doc_tokens", pa.list_(pa.int64())), ("marks", pa.binary()), ("bits", pa.binary())])


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids) of a file set; start counts the ids of all documents before."""
    code = spark.read.schema("symbol long, bits int").parquet(f"{path}/code").collect()  # at most one row a vocabulary entry
    lengths = np.zeros(max((r.symbol for r in code), default=0) + 1, np.int64)
    for r in code:
        lengths[r.symbol] = r.bits
    stored = spark.read.schema(BLOCKS).parquet(f"{path}/blocks")

    def run(batches):
        symbol, length, longest = tables(lengths)
        for batch in batches:
            for row in range(batch.num_rows):
                part, _, start, docs, sizes, marks, bits = (c[row].as_py() for c in batch.columns)
                ids = unpack_block(marks, bits, sum(sizes), symbol, length, longest).astype("<u4").tobytes()
                ends = np.cumsum(sizes)
                at = ends - sizes
                cut = [ids[4 * a : 4 * b] for a, b in zip(at.tolist(), ends.tolist())]
                yield pa.record_batch([pa.array(docs, pa.int64()), pa.array([part] * len(docs), pa.int32()), pa.array(at + start, pa.int64()), pa.array(sizes, pa.int64()), pa.array(cut, pa.binary())], names=["doc_id", "part", "at", "n_tokens", "ids"])

    total = stored.select("part", F.aggregate("doc_tokens", F.lit(0).cast("long"), lambda a, b: a + b).alias("n")).groupBy("part").agg(F.sum("n").alias("n")).collect()  # a row for each part
    before, base = 0, {}
    for r in sorted(total):
        base[r.part], before = before, before + r.n

    bases = spark.createDataFrame(list(base.items()), "part int, base long")
    return stored.mapInArrow(run, TOKENS).join(F.broadcast(bases), "part").select("doc_id", (F.col("at") + F.col("base")).alias("start"), "n_tokens", "ids")
