"""What each of several filters removes in every order, with duplicates found by sorting.

Rows are range-sorted by text fingerprint, text and doc_id, so that equal texts stand
together and each row is compared with those before it. The ranges are cut by
fingerprint and doc_id alone: the planner samples range keys to the driver, where whole
texts would not fit, and a text that a third of the rows have is dealt over many ranges.
A range's first and last fingerprint may go on in its neighbours; what a range must know
of the ones before it, a digest and the smallest doc_id of the texts of one fingerprint,
is one small row a range.

A row's failed filters are a bit mask. Rows add up to counters of (part, mask, labels),
at most 2**5 masks a part, from which all orders are counted.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from isoloom.llm.common import UPPER, Staged

LETTERS = "ABCDE"
COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost")
_ROW = "doc_id long, part string, mask int, range int, head int, first_print long, last_print long, heads array<binary>, tails array<binary>, tail_ids array<long>"
#: UTF-8 bytes that continue a code point.
_INSIDE = bytes(range(0x80, 0xC0))


@dataclass(frozen=True)
class Rules:
    """A: under ``min_words`` words; B: distinct words below ``min_distinct`` percent; C: A-Z
    above ``max_upper`` percent of code points; D: holds one of ``symbols``; E: a copy."""

    min_words: int = 200
    min_distinct: int = 50
    max_upper: int = 3
    symbols: str = "#$%&*|"

    def mask(self, raw: bytes) -> int:
        """Bits of A to D. bytes.split knows exactly the blanks of the word rule."""
        found = raw.split()
        out = int(len(found) < self.min_words)
        out |= int(100 * len(set(found)) < self.min_distinct * len(found)) << 1
        upper = len(raw) - len(raw.translate(None, UPPER.encode()))
        points = len(raw.translate(None, _INSIDE))
        out |= int(100 * upper > self.max_upper * points) << 2
        return out | int(len(raw) > len(raw.translate(None, self.symbols.encode()))) << 3


def failures(docs: DataFrame, rules: Rules = Rules(), id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang", staged: Staged | None = None) -> DataFrame:
    """(doc_id, part, mask) of every row: bit i of mask is set if it fails filter LETTERS[i].

    E fails rows whose whole text some smaller doc_id has, too; equal rows of one id are no
    copies of each other. A null text is an empty one, and a null part an empty string. A row
    without doc_id is never a copy, and nothing is a copy of it. Further columns are not
    read; an empty table gives no row.
    """
    staged = staged or Staged(docs.sparkSession, "audit")
    raw = F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary")
    rows = docs.select(F.xxhash64(raw).alias("print"), raw.alias("raw"), F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"))
    last = F.col("doc_id").asc_nulls_last()
    ranges = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    schema = pa.schema([("doc_id", pa.int64()), ("part", pa.string()), ("mask", pa.int32()), ("range", pa.int32()), ("head", pa.int32()), ("first_print", pa.int64()), ("last_print", pa.int64()), ("heads", pa.list_(pa.binary())), ("tails", pa.list_(pa.binary())), ("tail_ids", pa.list_(pa.int64()))])

    def compare(batches):
        first = here = None  # fingerprints
        heads: list[bytes] = []  # texts of the first fingerprint
        least: dict[bytes, int | None] = {}  # smallest doc_id of each text of the present one
        before, mask, at = None, 0, TaskContext.get().partitionId()
        for batch in batches:
            prints, ids = batch.column(0).to_pylist(), batch.column(2).to_pylist()
            masks, head = [], []
            for i, doc_id in enumerate(ids):
                text = batch.column(1)[i].as_py()
                if text != before:
                    before, mask = text, rules.mask(text)
                if prints[i] != here:
                    here, least = prints[i], {}
                    first = here if first is None else first
                if text not in least:
                    least[text] = doc_id
                    if here == first:
                        heads.append(text)
                known = least[text]
                masks.append(mask | (known is not None and doc_id is not None and known < doc_id) << 4)
                head.append(heads.index(text) if here == first else -1)
            n = len(ids)
            yield pa.record_batch([batch.column(2).cast(pa.int64()), batch.column(3).cast(pa.string()), pa.array(masks, pa.int32()), pa.array([at] * n, pa.int32()), pa.array(head, pa.int32()), *[pa.nulls(n, f.type) for f in [*schema][5:]]], schema=schema)
        if first is not None:
            digest = lambda text: hashlib.sha256(text).digest()
            edge = [None, None, None, at, None, first, here, [digest(x) for x in heads], [digest(x) for x in least], [*least.values()]]
            yield pa.record_batch([pa.array([x], f.type) for x, f in zip(edge, schema)], schema=schema)

    ranged = rows.repartitionByRange(max(1, ranges), "print", last).sortWithinPartitions("print", "raw", last)
    marked = staged.write(ranged.mapInArrow(compare, _ROW), "marked")
    known = _carried(marked)
    out = marked.where("mask is not null").select("doc_id", "part", "mask", "range", "head")
    if known:
        carried = docs.sparkSession.createDataFrame(known, "range int, head int, known long")
        out = out.join(F.broadcast(carried), ["range", "head"], "left").withColumn("mask", F.when(F.col("known") < F.col("doc_id"), F.col("mask").bitwiseOR(16)).otherwise(F.col("mask")))
    return out.select("doc_id", "part", "mask")


def _carried(marked: DataFrame) -> list[tuple[int, int, int]]:
    """(range, head, smallest doc_id before the range) of first texts that earlier ranges hold,
    from one row a range. Digests stand for texts here alone."""
    out: list[tuple[int, int, int]] = []
    here, known = None, {}  # the last fingerprint so far, and its texts
    edges = marked.where("mask is null").select("range", "first_print", "last_print", "heads", "tails", "tail_ids")
    for e in sorted(edges.collect()):
        if e.first_print == here:
            out += [(e.range, i, known[x]) for i, x in enumerate(map(bytes, e.heads)) if known.get(x) is not None]
        if e.last_print != here:
            here, known = e.last_print, {}
        for x, doc_id in zip(map(bytes, e.tails), e.tail_ids):
            if known.get(x) is None:  # ids ascend from range to range
                known[x] = doc_id
    return out


def _bits(letters: Column) -> Column:
    """The mask of letters."""
    return sum((F.when(letters.contains(x), 1 << i).otherwise(0) for i, x in enumerate(LETTERS)), F.lit(0))


def interactions(failed: DataFrame) -> DataFrame:
    """For every part, order and step of (part, mask, good, toxic) rows, what the step's filter does.

    Rows add up to counters of their masks first, and a part has at most 32 of them, so
    orders are counted on a few rows. ``good`` and ``toxic`` are booleans or null. A filter's
    shapley is what it removes over all orders: of the rows that fail k filters, each of these
    comes first in 120 / k orders. An empty table gives no part.
    """
    yes = lambda c: F.sum(F.when(F.col(c), 1).otherwise(0))
    cells = failed.groupBy("part", "mask").agg(F.count("*").alias("n"), yes("good").alias("good"), yes("toxic").alias("toxic"))
    orders = F.array(F.lit(""))
    for _ in LETTERS:
        orders = F.flatten(F.transform(orders, lambda o: F.transform(F.filter(F.array(*map(F.lit, LETTERS)), lambda x: ~o.contains(x)), lambda x: F.concat(o, x))))
    steps = cells.withColumn("filter_order", F.explode(orders)).withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(len(LETTERS)))))
    steps = steps.withColumn("own", _bits(F.col("filter_order").substr(F.col("step"), F.lit(1)))).withColumn("before", _bits(F.col("filter_order").substr(F.lit(1), F.col("step") - 1)))
    gone = F.col("mask").bitwiseAND(F.col("before")) != 0
    fails = F.col("mask").bitwiseAND(F.col("own")) != 0
    count = lambda when, what="n": F.sum(F.when(when, F.col(what)).otherwise(0)).cast("long")
    share = F.col("n") * F.expr("120 div greatest(bit_count(mask), 1)")
    out = steps.groupBy("part", "filter_order", "step").agg(
        count(~gone & ~fails).alias("kept"), count(~gone & fails).alias("removed"), count(gone & fails).alias("redundant"), count(F.col("mask") == F.col("own")).alias("unique_fails"),
        count(~gone & fails, "good").alias("good_lost"), count(~gone & fails, "toxic").alias("toxic_lost"), F.sum(F.when(fails, share).otherwise(0)).cast("long").alias("shapley"),
    )
    return out.select("part", "filter_order", F.col("step").cast("int"), *COUNTS, "shapley")


def audit(docs: DataFrame, labels: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """``interactions`` of the filters on documents; labels (doc_id, quality, toxic) say what is lost.

    An id counts as good or toxic if any of its label rows says 1; ids without labels, and
    rows without id, are neither.
    """
    said = labels.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max(F.col("quality") == 1).alias("good"), F.max(F.col("toxic") == 1).alias("toxic"))
    return interactions(failures(docs, rules).join(said, "doc_id", "left"))
