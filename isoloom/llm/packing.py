"""Best-fit packing of token pieces by length patterns.

The histogram of piece lengths is all that reaches the driver: at most
``capacity`` numbers, however many pieces there are. There, patterns of up to
three lengths that fill a sequence exactly are enumerated, their repeat counts
are fitted to the histogram by non-negative least squares and rounded so that
no length is used more often than it occurs, and what is left is packed best
fit first, by counts. A few ways to round are tried. The outcome is a list of (pattern, repeats). Pieces of a
length are numbered in parallel, and a piece's number says which repeat of
which pattern holds it.
"""

from __future__ import annotations

import bisect

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from isoloom.llm.common import Staged, free, row_of
from isoloom.llm.tokens import binary_slices, encode_parts, with_end

#: Least fitted repeats of a pattern that is used, as tried.
ROUNDING = (0.02, 0.1, 0.2, 0.5, 1.0)
PIECES = "doc_id long, piece int, start long, length long, ids binary"


def pieces(docs: DataFrame, tokenizer: str, capacity: int = 1024, end_id: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Token pieces of every whole text, as (doc_id, piece, start, length, ids).

    A null or empty text is its end id alone. Texts of more than ``capacity``
    ids are cut into pieces of ``capacity``; the first may be shorter. ids are
    little-endian unsigned 32-bit. A repeated row gives its pieces again; other
    columns are not read. An empty table gives no piece.
    """

    def run(batches):
        for batch in batches:
            doc = batch.column(0).cast(pa.int64()).to_numpy(zero_copy_only=False)
            null = batch.column(0).is_null().to_numpy(zero_copy_only=False)
            for row, ids, ends in encode_parts(batch.column(1), tokenizer):
                ids, ends = with_end(ids, ends, end_id)
                n = np.diff(ends, prepend=0)
                many = (n - 1) // capacity
                of = np.repeat(np.arange(len(n)), many + 1)
                piece = np.arange(len(of)) - np.repeat(np.cumsum(many + 1) - many - 1, many + 1)
                start = np.where(piece > 0, (n - many * capacity)[of] + (piece - 1) * capacity, 0)
                stop = (n - many * capacity)[of] + piece * capacity
                cut = (ends - n)[of] + stop
                yield pa.record_batch([pa.array(doc[row + of], pa.int64(), mask=null[row + of]), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(stop - start, pa.int64()), binary_slices(ids, cut)], names=["doc_id", "piece", "start", "length", "ids"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, PIECES)


def exact_patterns(present: np.ndarray, capacity: int) -> np.ndarray:
    """Rows of three ascending lengths (0: none) that sum to capacity, of present lengths only."""
    have = np.zeros(capacity + 1, bool)
    have[present] = True
    have[0] = True
    found = []
    for a in np.flatnonzero(have[: capacity // 3 + 1]):
        b = np.arange(a, (capacity - a) // 2 + 1)
        c = capacity - a - b
        ok = have[b] & have[c]
        found.append(np.stack([np.full(ok.sum(), a), b[ok], c[ok]], 1))
    return np.concatenate(found) if found else np.zeros((0, 3), int)


def fit(patterns: np.ndarray, counts: np.ndarray, rounds: int = 400) -> np.ndarray:
    """Non-negative repeats whose lengths come nearest to counts by least squares.

    Multiplicative updates keep every repeat at 0 or more. Short lengths weigh
    less, since what is left of them fills gaps.
    """
    size = len(counts)
    weight = np.linspace(0.1, 1.0, size)
    weight[0] = 0.0
    x = np.ones(len(patterns)) * max(1.0, counts.sum()) / max(1, 3 * len(patterns))
    up = (weight * counts)[patterns].sum(1)
    for _ in range(rounds):
        used = np.bincount(patterns.ravel(), np.repeat(x, 3), size)
        x *= up / np.maximum((weight * used)[patterns].sum(1), 1e-12)
    return x


def best_fit(left: dict[int, int], capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Patterns with repeats for counts of lengths: longest first, each into the
    fullest sequence that still takes it, equal cases at once."""
    groups: dict[int, list[tuple[tuple[int, ...], int]]] = {}
    spaces: list[int] = []

    def put(space: int, pattern: tuple[int, ...], n: int) -> None:
        if n:
            if space not in groups:
                bisect.insort(spaces, space)
                groups[space] = []
            groups[space].append((pattern, n))

    for length in sorted(left, reverse=True):
        todo = left[length]
        while todo:
            at = bisect.bisect_left(spaces, length)
            if at == len(spaces):
                put(capacity, (), todo)
                continue
            space = spaces[at]
            pattern, n = groups[space].pop()
            if not groups[space]:
                del groups[space]
                spaces.pop(at)
            each = min(space // length, todo)
            full = min(n, todo // each)
            put(space, pattern, n - full)
            put(space - each * length, (*pattern, *[length] * each), full)
            todo -= full * each
    return [(p, n) for g in groups.values() for p, n in g if p]


def plan(histogram: dict[int, int], capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """(pattern, repeats) that hold every counted length once. Of the ways to round the
    fitted repeats, the one that needs the fewest sequences is taken."""
    counts = np.zeros(capacity + 1)
    for k, n in histogram.items():
        counts[k] = n
    patterns = exact_patterns(np.array(sorted(histogram), int), capacity)
    x = fit(patterns, counts) if len(patterns) else np.zeros(0)
    plans = [_rounded(patterns, x, least, histogram, capacity) for least in ROUNDING]
    return min(plans, key=lambda p: sum(n for _, n in p))


def _rounded(patterns: np.ndarray, x: np.ndarray, least: float, histogram: dict[int, int], capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Patterns of at least ``least`` fitted repeats, largest first, as often as their rounded
    repeats and what is left of their lengths allow; best fit for the rest."""
    left = {int(k): int(n) for k, n in histogram.items()}
    out: list[tuple[tuple[int, ...], int]] = []
    for i in np.argsort(-x, kind="stable"):
        if x[i] < least:
            break
        row = [int(k) for k in patterns[i] if k]
        n = min(max(1, round(x[i])), *[left[k] // row.count(k) for k in row])
        if n:
            out.append((tuple(sorted(row, reverse=True)), n))
            for k in row:
                left[k] -= n
    return out + best_fit({k: n for k, n in left.items() if n}, capacity)


def _slots(chosen: list[tuple[tuple[int, ...], int]]) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Of each length: where runs of piece numbers begin, and their first sequence and offset."""
    first, runs, at = 0, {}, {}
    for pattern, n in chosen:
        offset = 0
        for length in pattern:
            got = at.get(length, 0)
            runs.setdefault(length, []).append((got, first, offset))
            at[length] = got + n
            offset += length
        first += n
    return {k: tuple(np.array(c, np.int64) for c in zip(*v)) for k, v in runs.items()}


def pack(table: DataFrame, capacity: int = 1024, length_col: str = "length", key_cols: tuple[str, ...] = ("doc_id", "piece"), bucket_rows: int = 100_000) -> DataFrame:
    """Adds sequence_id and offset to rows with lengths of 1 to capacity.

    All rows and columns stay, whatever their names; only sequence_id and offset must not be
    there yet (ValueError). Every row gets a place; sequences are filled without gaps from offset 0.
    Rows with equal keys are told apart arbitrarily, and each has its own place.
    An empty table stays empty. Numbers within a length are dealt in buckets of
    about ``bucket_rows``, so a length that a third of the rows have is not one task.
    """
    free(table, ("sequence_id", "offset"))
    staged = Staged(table.sparkSession, "packing")
    names = table.columns
    of = F.col("row").getField
    table = table.select(row_of(table).alias("row")).select("row", of(length_col).cast("long").alias("size"), F.xxhash64(*[of(c) for c in key_cols]).alias("key"))
    table = staged.write(table, "pieces")
    histogram = {r[0]: r[1] for r in table.groupBy("size").count().collect()}
    if any(k is None or not 0 < k <= capacity for k in histogram):
        raise ValueError(f"lengths must be 1 to {capacity}")
    slots = _slots(plan(histogram, capacity))
    most = max(histogram.values(), default=0)
    deep = {k: -(-n // bucket_rows) for k, n in histogram.items() if n > bucket_rows}
    buckets = F.coalesce(F.create_map(*[F.lit(v) for kv in deep.items() for v in kv])[F.col("size")], F.lit(1)) if deep else F.lit(1)
    table = table.withColumn("bucket", F.pmod("key", buckets.cast("long")))
    ranked = table.withColumn("rank", F.row_number().over(Window.partitionBy("size", "bucket").orderBy("key", *[of(c) for c in key_cols])).cast("long") - 1)
    if most > bucket_rows:
        before = Window.partitionBy("size").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
        base = table.groupBy("size", "bucket").count().select("size", "bucket", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("base"))
        ranked = ranked.join(base, ["size", "bucket"]).withColumn("rank", F.col("rank") + F.col("base"))

    @F.pandas_udf("struct<sequence_id:long,offset:long>")
    def place(length, rank):
        import pandas as pd

        length, rank = length.to_numpy(), rank.to_numpy()
        seq, off = np.zeros(len(rank), np.int64), np.zeros(len(rank), np.int64)
        for k in np.unique(length):
            here = length == k
            lo, first, offset = slots[int(k)]
            i = np.searchsorted(lo, rank[here], side="right") - 1
            seq[here] = first[i] + rank[here] - lo[i]
            off[here] = offset[i]
        return pd.DataFrame({"sequence_id": seq, "offset": off})

    return ranked.withColumn("place", place("size", "rank")).select(*[of(c).alias(c) for c in names], "place.sequence_id", "place.offset")
