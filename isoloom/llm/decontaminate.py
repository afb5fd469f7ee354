"""Benchmark decontamination by BM25 with block-max WAND.

Test items are the index, passages of the training texts the queries. An item's
BM25 impacts are divided by its score for itself, so a passage's score is the
share of the item that it holds, and one threshold serves all items.
"""

from __future__ import annotations

import re
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from isoloom.llm.common import ascii_lower, spare, words

HITS = "doc_id long, item_id long, passage long, start_word long, score double, question_overlap double, answer_overlap double, item_overlap double"
_HITS = pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64()), ("passage", pa.int64()), ("start_word", pa.int64()), ("score", pa.float64()), ("question_overlap", pa.float64()), ("answer_overlap", pa.float64()), ("item_overlap", pa.float64())])
K1, LENGTH_SHARE = 1.2, 0.75
#: Entries of the table of blocks that an index holds besides its lists, at most.
TABLE = 1 << 19


def question_answer(text: str) -> tuple[list[bytes], list[bytes]]:
    """Words of an item's question and answer: the last sentence answers. An item of
    one sentence is answered by its last quarter of words."""
    found = words(text)
    last = words(re.split(r"(?<=[.?!])\s+|\n", text.strip())[-1])
    n = len(last) if 0 < len(last) < len(found) else max(1, len(found) // 4)
    return found[:-n], found[-n:]


def grams(found: list[bytes], k: int = 5) -> set[tuple[bytes, ...]]:
    if len(found) < k:
        return {tuple(found)} - {()}
    return set(zip(*[found[i:] for i in range(k)]))


def item_overlap(item: list[bytes], passage: list[bytes], own: set[tuple[bytes, ...]]) -> float:
    """Share of the whole item's five-word shingles in the passage; 1 where the item stands
    verbatim, even if other text is glued to its ends. At the ends of an item below five
    words, letters and digits must not run on, lest parts of words count."""
    asked = grams(item)
    share = len(asked & own) / len(asked) if len(item) >= 5 else 0.0
    if share == 1.0:
        return share
    verbatim, text = b" ".join(item).decode("utf-8", "surrogatepass"), b" ".join(passage).decode("utf-8", "surrogatepass")
    if len(item) >= 5:
        return 1.0 if verbatim in text else share
    return float(bool(re.search(rf"(?<!\w){re.escape(verbatim)}(?!\w)", text)))


class Index:
    """Postings of items, in blocks of items with the greatest impact of each term."""

    def __init__(self, items: list[tuple[int, str, dict[bytes, float]]], mean: float, block: int = 8, terms: dict[bytes, int] | None = None):
        self.items = [(i, *question_answer(text)) for i, text, _ in items]
        self.longest = max((len(q) + len(a) for _, q, a in self.items), default=1)
        #: Numbers of terms from 1; indexes may share them.
        self.terms = terms if terms is not None else {}
        posts: list[list[tuple[int, float]]] = [[] for _ in range(len(self.terms) + 1)]
        for n, (_, text, idf) in enumerate(items):
            found = words(text)
            count: dict[bytes, int] = {}
            for w in found:
                count[w] = count.get(w, 0) + 1
            norm = K1 * (1 - LENGTH_SHARE + LENGTH_SHARE * len(found) / mean)
            impact = {w: idf[w] * f * (K1 + 1) / (f + norm) for w, f in count.items()}
            whole = sum(impact.values())
            for w, x in impact.items():
                t = self.terms.setdefault(w, len(posts))
                if t == len(posts):
                    posts.append([])
                posts[t].append((n, x / whole))
        self.block, self.n = block, len(items)
        self.most = np.array([max((p[1] for p in x), default=0.0) for x in posts])
        self.starts, self.item, self.impact = _flat(posts)
        heads = []
        for x in posts:
            best: dict[int, float] = {}
            for n, v in x:
                best[n // block] = max(best.get(n // block, 0.0), v)
            heads.append(sorted(best.items()))
        self.block_starts, self.block_of, self.block_most = _flat(heads)
        #: The blocks' greatest impacts as a table of terms and blocks, where it is small.
        self.table = None
        if len(posts) * (blocks := -(-self.n // block)) <= TABLE:
            self.table = np.zeros((len(posts), max(1, blocks)))
            self.table[np.repeat(np.arange(len(posts)), np.diff(self.block_starts)), self.block_of] = self.block_most

    def postings(self, term: int) -> tuple[np.ndarray, np.ndarray]:
        a, b = self.starts[term], self.starts[term + 1]
        return self.item[a:b], self.impact[a:b]

    def essential(self, threshold: float) -> np.ndarray:
        """Terms of which a passage above the threshold must hold one: all others together stay below it."""
        order = np.argsort(self.most)
        out = np.cumsum(self.most[order]) >= threshold
        essential = np.zeros(len(self.most), bool)
        essential[order] = out
        return essential

    def search(self, terms: np.ndarray, threshold: float) -> list[tuple[int, float]]:
        """Items whose score for the distinct terms reaches the threshold, by block-max WAND.

        A cursor a term stands on its next item. Cursors in order of their items, the first
        whose greatest impacts together reach the threshold end at the pivot: no item before it
        can. If the greatest impacts of the pivot's block do not reach it either, these cursors
        skip the block, or what of it lies before the next cursor; if all stand on the pivot, it is
        scored; else those before it skip to it. Most passages end before that, as no block's
        impacts of all their terms reach the threshold.
        """
        limit = threshold - 1e-9
        if self._bounds(terms).max() < limit:
            return []
        out = []
        cursors = [c for t in terms if (c := Cursor(self, int(t))).item is not None]
        while cursors:
            cursors.sort(key=lambda c: c.item)
            mass, last = 0.0, 0
            for last, c in enumerate(cursors, 1):
                mass += c.most
                if mass >= limit:
                    break
            if mass < limit:
                break
            pivot = cursors[last - 1].item
            while last < len(cursors) and cursors[last].item == pivot:
                last += 1
            first = cursors[:last]
            block = pivot // self.block
            if sum(c.block_most(block) for c in first) < limit:
                after = (block + 1) * self.block
                target = min(after, cursors[last].item) if last < len(cursors) else after
            elif first[0].item == pivot:
                score = sum(c.impact() for c in first)
                if score >= limit:
                    out.append((pivot, float(score)))
                target = pivot + 1
            else:
                target = pivot
            for c in first:
                c.skip(target)
            cursors = [c for c in cursors if c.item is not None]
        return out


    def _bounds(self, terms: np.ndarray) -> np.ndarray:
        """The greatest impacts of all terms together, by block."""
        if self.table is not None:
            return self.table[terms].sum(0)
        at = _slices(self.block_starts, terms)
        return np.bincount(self.block_of[at], self.block_most[at], 1)


class Cursor:
    """A place in the postings of a term."""

    def __init__(self, index: Index, term: int):
        self.index, self.most = index, float(index.most[term])
        self.at, self.end = int(index.starts[term]), int(index.starts[term + 1])
        self.blocks = slice(int(index.block_starts[term]), int(index.block_starts[term + 1]))
        self.item = int(index.item[self.at]) if self.at < self.end else None

    def skip(self, item: int) -> None:
        """On to the first item that is not before the given one; None at the end."""
        if self.item is not None and self.item < item:
            self.at += int(np.searchsorted(self.index.item[self.at : self.end], item))
            self.item = int(self.index.item[self.at]) if self.at < self.end else None

    def impact(self) -> float:
        return float(self.index.impact[self.at])

    def block_most(self, block: int) -> float:
        """The greatest impact in a block of items."""
        blocks = self.index.block_of[self.blocks]
        i = int(np.searchsorted(blocks, block))
        return float(self.index.block_most[self.blocks][i]) if i < len(blocks) and blocks[i] == block else 0.0


def _flat(lists: list[list[tuple[int, float]]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, numbers, values) of lists laid end to end."""
    starts = np.concatenate(([0], np.cumsum([len(x) for x in lists]))).astype(np.int64)
    return starts, np.array([n for x in lists for n, _ in x], np.int64), np.array([v for x in lists for _, v in x])


def _slices(starts: np.ndarray, which: np.ndarray) -> np.ndarray:
    """Places of all elements of some lists."""
    lo = starts[which]
    n = starts[which + 1] - lo
    return np.repeat(lo - np.cumsum(n) + n, n) + np.arange(n.sum())


def length_class(n: int) -> int:
    """Items of a class differ in length by a factor of two at most, but for those of up to 16 words."""
    return max(4, (n - 1).bit_length())


def _hits(ids, texts, indexes: list[tuple[Index, np.ndarray]], threshold: float, overlap: float) -> list[tuple]:
    """Hits of some documents in indexes that share their terms, each with its essential terms."""
    rows = []
    for doc, text in zip(ids, texts):
        found = words(text)
        if not found:
            continue
        terms = indexes[0][0].terms
        known = np.fromiter(map(terms.get, found, repeat(0)), np.int64, len(found))
        for index, essential in indexes:
            here = np.where(known < len(index.most), known, 0)
            rows += _class_hits(doc, found, here, index, essential, threshold, overlap)
    return rows


def _class_hits(doc, found, known, index: Index, essential, threshold: float, overlap: float) -> list[tuple]:
    stride = index.longest
    at = np.arange(0, max(1, len(found) - stride), stride)
    last = np.minimum(at + 2 * stride, len(found))
    needed = np.concatenate(([0], np.cumsum(essential[known])))
    mass = np.concatenate(([0], np.cumsum(index.most[known])))
    may = np.flatnonzero((needed[last] > needed[at]) & (mass[last] - mass[at] >= threshold - 1e-9))
    best: dict[int, tuple] = {}
    for p in may:
        here = np.unique(known[at[p] : last[p]])
        here = here[here > 0]
        if index.most[here].sum() < threshold - 1e-9:
            continue
        passage = None
        for n, score in index.search(here, threshold):
            if passage is None:
                passage = found[at[p] : last[p]]
                own, single = grams(passage), set(passage)
            item, question, answer = index.items[n]
            if len(question) >= 5:
                asked = grams(question)
                q = len(asked & own) / len(asked)
            else:  # too short for a shingle: it stands there or not
                q = float(not question or tuple(question) in grams(passage, len(question)))
            a = sum(w in single for w in answer) / len(answer)
            if n in best and best[n][4] >= score:
                continue
            w = item_overlap(question + answer, passage, own)
            if w >= overlap or (q >= overlap and a >= overlap):
                best[n] = (doc, item, int(p), int(at[p]), score, q, a, w)
    return list(best.values())


def find_leaks(docs: DataFrame, items: DataFrame, threshold: float = 0.6, overlap: float = 0.75, shard_bytes: int = 8 << 20, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """HITS rows: the best passage of each document for each item it leaks.

    Items are searched by classes of length (length_class). A class's passages are
    windows of twice its longest item's words, half overlapping, so each place where
    an item could stand is whole in one, and no item is sought in passages made for
    much longer ones. ``passage`` numbers the windows of the item's class. All items that score
    ``threshold`` or more for a passage are retrieved; hits have ``overlap`` or
    more of the question's five-word shingles and of the answer's words in it, or
    of the whole item's shingles (``item_overlap``): a short answer with text
    glued to its end has too few whole words left.

    The items are indexed in shards below ``shard_bytes`` of text, each sent to
    all workers and scored with statistics of all items; a benchmark of one shard,
    the usual case, means one pass over the documents. Null, empty and blank texts
    and items have no hits. Repeated items are items of their own; a repeated row
    gives its hits again. Empty tables give no rows.
    """
    items = items.select(F.col(item_col).cast("long").alias("item"), F.col(item_text_col).cast("string").alias("text")).where("trim(coalesce(text, '')) <> ''").dropDuplicates()
    size = items.agg(F.count("*").alias("n"), F.sum(F.octet_length("text")).alias("bytes")).first()
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    none = docs.limit(0).selectExpr(*[f"cast(null as {c.split()[1]}) as {c.split()[0]}" for c in HITS.split(", ")])
    if not size.n:
        return none
    shards = -(-size.bytes // shard_bytes)
    items = items.withColumn("shard", F.pmod(F.xxhash64("item", "text"), F.lit(shards)))

    split = F.filter(F.split(ascii_lower(F.col("text")), "[\\x20\\x09-\\x0D]+"), lambda w: w != "")
    items = items.withColumn("words", split).where("size(words) > 0")
    facts = items.agg(F.avg(F.size("words")), F.count("*")).first()
    if not facts[1]:
        return none
    terms = items.select("item", "shard", "text", F.explode(F.array_distinct("words")).alias("term"))
    held = terms.groupBy("term").agg(F.count("*").alias("df"))
    idf = F.log(1 + (facts[1] - F.col("df") + 0.5) / (F.col("df") + 0.5))
    weighted = terms.join(held, "term").groupBy("shard", "item", "text").agg(F.collect_list(F.struct("term", idf.alias("idf"))).alias("terms"))
    out = None
    for shard in range(shards):
        rows = weighted.where(F.col("shard") == shard).select("item", "text", "terms").orderBy("item", "text").collect()  # below shard_bytes of text
        if not rows:
            continue
        classes: dict[int, list] = {}
        for r in rows:
            classes.setdefault(length_class(len(words(r.text))), []).append((r.item, r.text, {t.term.encode("utf-8"): t.idf for t in r.terms}))
        shared: dict[bytes, int] = {}
        sent = docs.sparkSession.sparkContext.broadcast([Index(classes[c], facts[0], terms=shared) for c in sorted(classes)])

        def run(batches, sent=sent):
            indexes = [(x, x.essential(threshold)) for x in sent.value]
            for batch in batches:
                for i in range(0, batch.num_rows, 1024):
                    part = batch.slice(i, 1024)
                    found = _hits(part.column(0).to_pylist(), part.column(1).to_pylist(), indexes, threshold, overlap)
                    cols = list(zip(*found)) if found else [[]] * len(_HITS)
                    yield pa.record_batch([pa.array(c, f.type) for c, f in zip(cols, _HITS)], schema=_HITS)

        hits = docs.mapInArrow(run, HITS)
        out = hits if out is None else out.unionByName(hits)
    return none if out is None else out


def drop_leaks(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of documents without any hit, with their columns as they were. Rows without id stay."""
    leak = spare(docs, "leak")
    leaks = find_leaks(docs, items, id_col=id_col, text_col=text_col, **options).select(F.col("doc_id").alias(leak)).distinct()
    return docs.join(leaks, F.col(id_col) == F.col(leak), "left_anti")
