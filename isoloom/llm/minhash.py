"""MinHash near-duplicates with b-bit signatures.

Documents with equal shingle sets are one class, its smallest doc_id standing
for it. Bands of full minima give candidates; their signatures, the low B bits
of PERMS minima packed into longs, estimate the similarity by bit counts,
corrected for chance agreement; and what may reach the limit is confirmed on
the whole texts.

Candidates never are all pairs of a bucket. First every class is compared with
the best of its buckets' leaders, the members that share most buckets with others:
a text that many others vary leads nearly everywhere, and joins nearly all of its
group. Then, exactly, the members of a bucket that are not yet in its main
component are compared with the rest of it, but for those that cannot reach the
limit: of a text's shingles, the ones that no other open text has are in no
intersection, and bitmaps of two texts' shingles bound their intersection, so that
of a large group hardly more pairs than links are confirmed.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from isoloom.llm.common import Staged, spare, words
from isoloom.llm.components import components

BANDS, ROWS, B = 32, 4, 4
PERMS = BANDS * ROWS
#: Candidates whose estimate is this much below the limit (over five standard deviations) are no links.
MARGIN = 0.2
#: Bits of a text's bitmap of shingles.
BITMAP = 4096
_RNG = np.random.default_rng(20240607)
_A = _RNG.integers(0, 2**63, PERMS, np.int64).astype(np.uint64) * np.uint64(2) + np.uint64(1)
_C = _RNG.integers(0, 2**63, PERMS, np.int64).astype(np.uint64)
_P, _Q = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
_SKETCH = pa.schema([("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("set_hash", pa.binary()), ("bands", pa.list_(pa.int64())), ("sig", pa.list_(pa.int64()))])
SKETCH = "doc_id long, n_shingles long, set_hash binary, bands array<long>, sig array<long>"


def shingles(hashes: np.ndarray, k: int = 5) -> np.ndarray:
    """Distinct hashes of the windows of k words; of all words if there are fewer."""
    if not len(hashes):
        return np.zeros(0, np.uint64)
    k = min(k, len(hashes))
    n = len(hashes) - k + 1
    out = np.full(n, k, np.uint64)
    for i in range(k):
        out = out * _P + hashes[i : i + n]
        out ^= out >> np.uint64(31)
    out *= _Q
    return np.unique(out ^ out >> np.uint64(29))


def minima(found: np.ndarray) -> np.ndarray:
    out = np.full(PERMS, np.iinfo(np.uint64).max, np.uint64)
    for i in range(0, len(found), 2048):
        out = np.minimum(out, (found[i : i + 2048, None] * _A + _C).min(0))
    return (out >> np.uint64(32)).astype(np.uint64)


def signature(low: np.ndarray) -> np.ndarray:
    """The low B bits of PERMS minima, 64 / B to a long."""
    each = 64 // B
    bits = (low & np.uint64((1 << B) - 1)).reshape(-1, each) << (np.arange(each, dtype=np.uint64) * np.uint64(B))
    return np.bitwise_or.reduce(bits, 1)


def sketch(docs: DataFrame, k: int = 5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """SKETCH rows of whole texts; a text without words has no set hash."""

    def run(batches):
        known: dict[bytes, int] = {}
        for batch in batches:
            for i in range(0, batch.num_rows, 256):
                part = batch.slice(i, 256)
                rows = []
                for doc, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    found = words(text)
                    if len(known) > 200_000:
                        known.clear()
                    for w in set(found):
                        if w not in known:
                            known[w] = xxhash.xxh3_64_intdigest(w)
                    s = shingles(np.fromiter(map(known.__getitem__, found), np.uint64, len(found)), k)
                    if not len(s):
                        rows.append((doc, 0, None, [], []))
                        continue
                    low = minima(s)
                    bands = np.arange(BANDS, dtype=np.uint64)
                    for row in low.reshape(BANDS, ROWS).T:
                        bands = (bands ^ row) * _P
                        bands ^= bands >> np.uint64(32)
                    rows.append((doc, len(s), xxhash.xxh3_128_digest(s.tobytes()), bands.view(np.int64), signature(low).view(np.int64)))
                cols = list(zip(*rows)) if rows else [[]] * 5
                yield pa.record_batch([pa.array(c, f.type) for c, f in zip(cols, _SKETCH)], schema=_SKETCH)

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, SKETCH)


def estimate(x: Column, y: Column) -> Column:
    """Similarity of two packed signatures: agreeing groups of B bits, less chance agreement."""
    ones = int("".join("0" * (B - 1) + "1" for _ in range(64 // B)), 2)

    def agree(i: int) -> Column:
        d = F.get(x, F.lit(i)).bitwiseXOR(F.get(y, F.lit(i)))
        d = d.bitwiseOR(F.shiftrightunsigned(d, 1))
        d = d.bitwiseOR(F.shiftrightunsigned(d, 2))
        return F.lit(64 // B) - F.bit_count(d.bitwiseAND(F.lit(ones)))

    share = sum((agree(i) for i in range(1, PERMS * B // 64)), agree(0)) / PERMS
    return (share - 2.0**-B) / (1 - 2.0**-B)


def confirm(pairs: DataFrame, texts: DataFrame, k: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose full shingle sets agree; texts has (id, text)."""

    def run(batches):
        def whole(text):
            found = words(text)
            return set(zip(*[found[i:] for i in range(k)])) if len(found) >= k else {tuple(found)} - {()}

        last, y = None, set()
        for batch in batches:
            for i in range(0, batch.num_rows, 64):
                part = batch.slice(i, 64)
                keep = []
                for ta, tb in zip(part.column(2).to_pylist(), part.column(3).to_pylist()):
                    if tb != last:
                        last, y = tb, whole(tb)
                    x = whole(ta)
                    both = len(x & y)
                    keep.append(both > 0 and 100 * both >= percent * (len(x) + len(y) - both))
                yield part.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    first = texts.select(F.col("id").alias("a"), F.col("text").alias("ta"))
    second = texts.select(F.col("id").alias("b"), F.col("text").alias("tb"))
    # the last join leaves rows in order of b, so its set is made once
    return pairs.join(first, "a").join(second, "b").select("a", "b", "ta", "tb").mapInArrow(run, "a long, b long")


PROFILE = "id long, shingles array<long>, bits array<long>, excess long"
_PROFILE = pa.schema([("id", pa.int64()), ("shingles", pa.list_(pa.int64())), ("bits", pa.list_(pa.int64())), ("excess", pa.int64())])


def profiles(texts: DataFrame, k: int) -> DataFrame:
    """PROFILE rows of texts (id, text): all shingles, the BITMAP bits that they set, and how
    many shingles found their bit set already."""

    def run(batches):
        for batch in batches:
            for i in range(0, batch.num_rows, 128):
                part = batch.slice(i, 128)
                found, bits, excess = [], [], []
                for text in part.column(1).to_pylist():
                    w = words(text)
                    s = shingles(np.fromiter(map(xxhash.xxh3_64_intdigest, w), np.uint64, len(w)), k)
                    on = np.zeros(BITMAP, np.uint8)
                    on[(s >> np.uint64(40)) % np.uint64(BITMAP)] = 1
                    found.append(s.view(np.int64))
                    bits.append(np.packbits(on).view(np.int64))
                    excess.append(len(s) - int(on.sum()))
                yield pa.record_batch([part.column(0), *[pa.array(c, f.type) for c, f in zip((found, bits, excess), list(_PROFILE)[1:])]], schema=_PROFILE)

    return texts.mapInArrow(run, PROFILE)


def lone_shingles(found: DataFrame) -> DataFrame:
    """(id, lone): how many of a text's shingles are in no other of these PROFILE rows."""
    seen = found.select("id", F.explode("shingles").alias("shingle"))
    lone = seen.groupBy("shingle").agg(F.count("*").alias("n"), F.min("id").alias("id")).where("n = 1")
    # texts that share an id keep all their shingles
    single = found.groupBy("id").agg(F.count("*").alias("rows")).where("rows = 1").select("id")
    return lone.groupBy("id").agg(F.count("*").alias("lone")).join(single, "id", "left_semi")


def most_common(x: str, y: str) -> Column:
    """No intersection of two sets is greater: both set at most these bits, and of the shingles that
    found their bit set already, the intersection has no more than either set has. x and y end the
    names of the columns of the two sides: m (shingles that others have, too), bits, excess."""
    both = F.aggregate(F.zip_with(f"bits{x}", f"bits{y}", lambda p, q: F.bit_count(p.bitwiseAND(q))), F.lit(0), lambda t, v: t + v)
    return F.least(F.col(f"m{x}"), F.col(f"m{y}"), both + F.least(f"excess{x}", f"excess{y}"))


def near_duplicates(docs: DataFrame, k: int = 5, percent: int = 75, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every row.

    Documents whose sets of k-word shingles have 100 * intersection >= percent *
    union are linked; component_id is the smallest doc_id reachable over links,
    the document itself included; kept is doc_id = component_id. Words are
    ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased. A text of fewer words is one
    shingle; null, empty and blank texts have none and no links. Rows that share
    a doc_id count as one document: each has its row, and they are linked. A row
    without doc_id has no links, a null component, and is kept. An empty table
    gives no row.
    """
    staged = Staged(docs.sparkSession, "minhash")
    limit = percent / 100
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    rows = staged.write(sketch(docs, k), "sketch")
    full = rows.where("set_hash is not null and doc_id is not null")
    classes = full.groupBy("set_hash").agg(F.min("doc_id").alias("id"))
    members = staged.write(full.select("doc_id", "set_hash").join(classes, "set_hash").select("doc_id", "id").distinct(), "members")
    own = full.join(members.where("doc_id = id").select("doc_id"), "doc_id").select(F.col("doc_id").alias("id"), "bands", "sig", "n_shingles")
    keys = own.select("id", F.explode("bands").alias("key"))
    shared = keys.groupBy("key").agg(F.min("id").alias("one"), F.max("id").alias("last"), F.count("*").alias("n")).where("one <> last").select("key", "n")
    met = staged.write(keys.join(shared, "key").select("key", "id", "n"), "met")
    ids = staged.write(met.groupBy("id").agg(F.sum("n").alias("met")), "ids")
    leaders = met.join(ids, "id").groupBy("key").agg(F.max("met").alias("most"))
    named = met.join(ids, "id").join(leaders, "key").where("met = most").groupBy("key").agg(F.min("id").alias("leader"))
    hits = staged.write(met.join(named, "key").select("key", "id", "leader"), "hits")
    staged.drop("met")
    own = staged.write(own.join(ids, "id").select("id", "bands", "sig", "n_shingles"), "signatures")
    texts = docs.where("doc_id is not null").join(ids.select(F.col("id").alias("doc_id")), "doc_id", "left_semi")
    texts = staged.write(texts.select(F.col("doc_id").alias("id"), "text"), "texts")

    likely = F.lit(limit - MARGIN)
    to_leader = hits.where("id <> leader").select("id", "leader").distinct()
    scored = to_leader.join(own.select("id", "sig"), "id").join(own.select(F.col("id").alias("leader"), F.col("sig").alias("other")), "leader").withColumn("e", estimate(F.col("sig"), F.col("other")))
    best = scored.where(F.col("e") >= likely).groupBy("id").agg(F.max_by("leader", F.struct("e", -F.col("leader"))).alias("leader"))
    # rows of one doc_id with different texts are linked as well
    same = members.where("doc_id <> id").select(F.col("doc_id").alias("a"), F.col("id").alias("b"))
    links = confirm(best.select(F.col("id").alias("a"), F.col("leader").alias("b")), texts, k, percent)
    links = staged.write(links, "links-1")
    found = staged.write(components(links, staged, "stars"), "stars")

    placed = hits.join(found, "id", "left").select("key", "id", F.coalesce("component", "id").alias("component"))
    sizes = placed.groupBy("key", "component").agg(F.count("*").alias("n"))
    main = sizes.groupBy("key").agg(F.max_by("component", F.struct("n", "component")).alias("main"), F.count("*").alias("n")).where("n > 1").select("key", "main")
    open_ = staged.write(placed.join(main, "key"), "places")
    found = staged.write(profiles(texts.join(open_.select("id").distinct(), "id", "left_semi"), k), "profiles")
    lone = staged.write(lone_shingles(found), "lone")
    # texts that share an id are told apart by no bitmap
    found = found.groupBy("id").agg(F.count("*").alias("rows"), F.any_value("bits").alias("bits"), F.max("excess").alias("excess"))
    found = found.select("id", F.when(F.col("rows") == 1, F.col("bits")).otherwise(F.array_repeat(F.lit(-1).cast("long"), BITMAP // 64)).alias("bits"), "excess")
    own = own.join(lone, "id", "left").withColumn("m", F.col("n_shingles") - F.coalesce("lone", F.lit(0)))
    own = own.where(100 * F.col("m") >= percent * F.col("n_shingles")).join(found, "id")
    open_ = staged.write(open_.join(own, "id"), "open")
    facts = ("id", "component", "sig", "bands", "n_shingles", "m", "bits", "excess")
    x = open_.where("component <> main").select("key", *[F.col(c).alias(f"{c}_a") for c in facts])
    y = open_.select("key", "main", *[F.col(c).alias(f"{c}_b") for c in facts])

    def reach(most: Column) -> Column:
        return 100 * most >= percent * (F.col("n_shingles_a") + F.col("n_shingles_b") - most)

    # the cheap conditions come first; of the buckets that two share, only the first pairs them
    near = x.join(y, "key").where((F.col("component_a") != F.col("component_b")) & ((F.col("component_b") == F.col("main")) | (F.col("id_a") > F.col("id_b"))) & reach(F.least("m_a", "m_b")) & (estimate(F.col("sig_a"), F.col("sig_b")) >= likely) & (F.get(F.array_intersect("bands_a", "bands_b"), F.lit(0)) == F.col("key")) & reach(most_common("_a", "_b")))
    near = near.select(F.greatest("id_a", "id_b").alias("a"), F.least("id_a", "id_b").alias("b")).distinct()
    more = staged.write(confirm(near, texts, k, percent), "links-2")
    staged.drop("hits", "places", "open", "profiles", "texts")

    component = components(links.unionByName(more).unionByName(same), staged, "all")
    named = component.withColumnRenamed("id", "doc_id")
    out = rows.select("doc_id", "n_shingles").join(named, "doc_id", "left")
    label = F.coalesce("component", "doc_id")
    return out.select("doc_id", "n_shingles", label.alias("component_id"), F.coalesce(F.col("doc_id") == label, F.lit(True)).alias("kept"))


def keep_one(docs: DataFrame, k: int = 5, percent: int = 75, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of the documents that near_duplicates keeps, with their columns as they were."""
    gone = spare(docs, "gone")
    rest = near_duplicates(docs, k, percent, id_col, text_col).where("not kept").select(F.col("doc_id").alias(gone)).distinct()
    return docs.join(rest, F.col(id_col) == F.col(gone), "left_anti")
