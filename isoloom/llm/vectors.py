"""Links between vectors of one label by an epsilon grid order join.

Two unit vectors with a cosine of at least ``limit`` lie within eps = sqrt(2 - 2 limit) of
each other, and so do their projections on any orthonormal axes. Vectors are projected on
leading principal axes and sorted by label and by the grid cells of side eps that their
first coordinates lie in. The sorted sequence is cut into intervals of bounded size, each
with a box around its projections; intervals whose boxes are more than eps apart are never
joined. Spark joins the ranges of the sort first, then the intervals of ranges that are
near; a task halves a pair of intervals on, until it is provably distant or small enough to
be multiplied out in double precision. No pair of vectors leaves a task: it gives, of each
vector with links there, their number and one vector that it is connected to.

Equal vectors are one class, its smallest id standing for it, so copies are joined once.
The axes are fitted on a bounded sample (about ``sample`` rows); they only set how much is
skipped, never what is found.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from isoloom.llm.common import Staged
from isoloom.llm.components import components

#: Coordinates that boxes are made of, and those of them whose cells sort.
AXES, CELLS = 16, 6
#: Rows that are multiplied out at once.
LEAF = 256
_SLACK = 1e-9
_INTERVAL = "range int, at int, label string, size int, n int, low array<double>, high array<double>, rep binary, weight binary, vec binary"


def unit(raw: np.ndarray) -> np.ndarray:
    """Rows in double precision with length 1; rows that are zero or not finite become nan."""
    x = raw.astype(np.float64)
    with np.errstate(all="ignore"):
        most = np.abs(x).max(1, initial=0.0)
        x = x / np.where((most > 0) & np.isfinite(most), most, np.nan)[:, None]  # squares of large numbers stay finite
        return x / np.sqrt((x * x).sum(1))[:, None]


def gap(low_a, high_a, low_b, high_b) -> float:
    """Squared distance of two boxes."""
    d = np.maximum(0.0, np.maximum(low_a - high_b, low_b - high_a))
    return float((d * d).sum())


def roots(n: int, u: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Of n nodes with edges (u, v), the smallest node that each is connected to."""
    root = np.arange(n)
    while True:
        m = np.minimum(root[u], root[v])
        new = root.copy()
        for at in (u, v, root[u], root[v]):
            np.minimum.at(new, at, m)
        while not np.array_equal(new, new[new]):
            new = new[new]
        if np.array_equal(new, root):
            return root
        root = new


class Joined:
    """Links between the rows of two intervals (of one with itself, if b is None)."""

    def __init__(self, a, b, axes: np.ndarray, limit: float):
        (ua, self.wa), (ub, self.wb) = a, a if b is None else b
        self.same, self.limit, self.eps2 = b is None, limit, 2 - 2 * limit + _SLACK
        self.ua, self.ub, self.ya, self.yb = ua, ub, ua @ axes, ub @ axes
        self.shift = 0 if self.same else len(ua)  # nodes of b come after those of a
        self.links = np.zeros(len(ua) + (0 if self.same else len(ub)), np.int64)
        self.edges: list[np.ndarray] = []
        self.join(0, len(ua), 0, len(ub))

    def join(self, i: int, j: int, k: int, m: int) -> None:
        """Rows i to j of a with k to m of b: skipped, multiplied out, or halved."""
        if self.same and k < i:
            return  # the other way round
        a, b = self.ya[i:j], self.yb[k:m]
        if gap(a.min(0), a.max(0), b.min(0), b.max(0)) > self.eps2:
            return
        if max(j - i, m - k) <= LEAF:
            self.leaf(i, j, k, m)
            return
        mid, cut = (i + j) // 2, (k + m) // 2
        for p, q in ((i, mid), (mid, j)) if j - i > LEAF else ((i, j),):
            for r, s in ((k, cut), (cut, m)) if m - k > LEAF else ((k, m),):
                self.join(p, q, r, s)

    def leaf(self, i: int, j: int, k: int, m: int) -> None:
        near = self.ua[i:j] @ self.ub[k:m].T >= self.limit
        if own := self.same and i == k:
            np.fill_diagonal(near, False)
        if not near.any():
            return
        self.links[i:j] += near @ self.wb[k:m]
        if not own:
            self.links[self.shift + k : self.shift + m] += self.wa[i:j] @ near
        # a spanning forest: every node and the smallest that it is connected to here
        row, col, none = np.arange(j - i), np.arange(j - i, j - i + m - k), j - i + m - k
        while True:
            less = np.minimum(col, np.where(near, row[:, None], none).min(0))
            low = np.minimum(row, np.where(near, less[None, :], none).min(1))
            if np.array_equal(low, row) and np.array_equal(less, col):
                break
            row, col = low, less
        root = np.concatenate([row, col])
        node = np.concatenate([np.arange(i, j), np.arange(self.shift + k, self.shift + m)])
        far = root != np.arange(len(root))
        self.edges.append(np.stack([node[far], node[root[far]]]))

    def found(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Nodes with links, how many, and a node that each is connected to."""
        at = np.flatnonzero(self.links)
        if not len(at):
            return at, at, at
        u, v = np.concatenate(self.edges, 1)
        return at, self.links[at], roots(len(self.links), u, v)[at]


def _axes(classes: DataFrame, sample: int, most_bytes: int = 32 << 20) -> dict[int, np.ndarray]:
    """Leading principal axes of each length of vector, from about ``sample`` classes, chosen by hash,
    or fewer if they were over ``most_bytes``."""
    n, longest = classes.agg(F.count("*"), F.max("size")).first()
    share = min(sample, max(1, most_bytes // (8 * (longest or 1)))) / max(n, 1)
    chosen = F.pmod(F.xxhash64("label", "vec"), F.lit(1 << 30)) < F.lit(int(min(1.0, share) * (1 << 30)))
    picked = classes.where(chosen).select("size", "vec").toPandas()
    out = {}
    for size, group in picked.groupby("size"):
        x = np.stack([np.frombuffer(v, np.float64) for v in group["vec"]])
        values, vectors = np.linalg.eigh(np.cov(x.T, bias=True).reshape(size, size) if len(x) > 1 else np.eye(size))
        out[int(size)] = np.ascontiguousarray(vectors[:, np.argsort(-values)[:AXES]])
    return out


def _near(a: str, b: str, eps2: float) -> Column:
    """Whether the boxes of two tables are at most eps apart."""
    low = F.zip_with(f"{a}.low", f"{b}.high", lambda x, y: x - y)
    high = F.zip_with(f"{b}.low", f"{a}.high", lambda x, y: x - y)
    apart = F.zip_with(low, high, lambda x, y: F.greatest(x, y, F.lit(0.0)))
    return F.aggregate(apart, F.lit(0.0), lambda s, x: s + x * x) <= eps2


def classes_of(vectors: DataFrame, id_col: str, vec_col: str, label_col: str) -> DataFrame:
    """(id, label, size, vec) of the rows that can link: vec is the unit vector in double precision."""

    def run(batches):
        for batch in batches:
            lists = batch.column(2)
            length = np.diff(lists.offsets.to_numpy())
            values = lists.values.fill_null(float("nan")).to_numpy(zero_copy_only=False)
            first = lists.offsets.to_numpy()[:-1]
            for size in np.unique(length[length > 0]):
                rows = np.flatnonzero(length == size)
                x = unit(values[first[rows][:, None] + np.arange(size)]) + 0.0  # no negative zeros
                good = np.isfinite(x).all(1)
                rows, x = rows[good], np.ascontiguousarray(x[good])
                at = pa.array(rows)
                vec = pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(np.arange(len(rows) + 1, dtype=np.int32) * np.int32(8 * size)), pa.py_buffer(x)])
                yield pa.record_batch([batch.column(0).take(at).cast(pa.int64()), batch.column(1).take(at).cast(pa.string()), pa.array(np.full(len(rows), size), pa.int32()), vec], names=["id", "label", "size", "vec"])

    some = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("string").alias("label"), F.col(vec_col).cast("array<double>").alias("v"))
    return some.where("id is not null and label is not null and v is not null").mapInArrow(run, "id long, label string, size int, vec binary")


def _intervals(classes: DataFrame, axes: dict[int, np.ndarray], eps: float, most_bytes: int) -> DataFrame:
    """Classes in epsilon grid order, cut into intervals of one label and size of vector."""
    cells = [f"c{i}" for i in range(CELLS)]

    def placed(batches):
        for batch in batches:
            size = batch.column(1).to_numpy()
            out = np.zeros((len(size), CELLS), np.int64)
            for s in np.unique(size):
                at = np.flatnonzero(size == s)
                x = np.stack([np.frombuffer(v.as_buffer(), np.float64) for v in batch.column(2).take(pa.array(at))])
                y = np.floor(x @ axes.get(int(s), np.eye(s)[:, :CELLS])[:, :CELLS] / eps)
                out[at, : y.shape[1]] = y
            yield pa.record_batch([*batch.columns, *[pa.array(out[:, i]) for i in range(CELLS)]], names=[*batch.schema.names, *cells])

    def cut(batches):
        at, held, key, room = 0, [], None, 0
        where = TaskContext.get().partitionId()

        def interval():
            x = np.stack([v for _, _, v in held])
            y = x @ axes.get(key[1], np.eye(key[1])[:, :AXES])
            low, high = np.zeros(AXES), np.zeros(AXES)
            low[: y.shape[1]], high[: y.shape[1]] = y.min(0), y.max(0)
            blobs = [np.array([r for r, _, _ in held], np.int64), np.array([w for _, w, _ in held], np.int64), x]
            row = [where, at, key[0], key[1], len(held), low.tolist(), high.tolist(), *[b.tobytes() for b in blobs]]
            types = [pa.int32(), pa.int32(), pa.string(), pa.int32(), pa.int32(), pa.list_(pa.float64()), pa.list_(pa.float64()), pa.binary(), pa.binary(), pa.binary()]
            return pa.record_batch([pa.array([v], t) for v, t in zip(row, types)], names=[f.split()[0] for f in _INTERVAL.split(", ")])

        for batch in batches:
            labels, sizes, reps, weights = (batch.column(i).to_pylist() for i in (0, 1, 3, 4))
            for i, (label, size) in enumerate(zip(labels, sizes)):
                if held and ((label, size) != key or len(held) >= room):
                    yield interval()
                    at, held = at + 1, []
                key, room = (label, size), max(16, most_bytes // (8 * size))
                held.append((reps[i], weights[i], np.frombuffer(batch.column(2)[i].as_buffer(), np.float64)))
        if held:
            yield interval()

    schema = "label string, size int, vec binary, rep long, weight long, " + ", ".join(f"{c} long" for c in cells)
    sequence = classes.select("label", "size", "vec", "rep", "weight").mapInArrow(placed, schema)
    order = ["label", "size", *cells, "rep"]
    ranges = int(classes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return sequence.repartitionByRange(max(1, ranges), *order).sortWithinPartitions(*order).mapInArrow(cut, _INTERVAL)


def _joined(pairs: DataFrame, axes: dict[int, np.ndarray], limit: float) -> DataFrame:
    """(rep, links, root) of every class with links, of each pair of intervals."""

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                size = batch.column(0)[i].as_py()
                read = lambda c, t: None if not batch.column(c)[i].is_valid else np.frombuffer(batch.column(c)[i].as_buffer(), t)  # noqa: B023, E731
                (ra, wa, va), (rb, wb, vb) = ((read(k, np.int64), read(k + 1, np.int64), read(k + 2, np.float64)) for k in (1, 4))
                b = None if rb is None else (vb.reshape(-1, size), wb)
                at, links, root = Joined((va.reshape(-1, size), wa), b, axes.get(size, np.eye(size)[:, :AXES]), limit).found()
                rep = ra if rb is None else np.concatenate([ra, rb])
                if len(at):
                    yield pa.record_batch([pa.array(rep[at]), pa.array(links), pa.array(rep[root])], names=["rep", "links", "root"])

    return pairs.mapInArrow(run, "rep long, links long, root long")


def links(vectors: DataFrame, limit: float = 0.98, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label", sample: int = 8192, most_bytes: int = 1 << 20) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row.

    Rows with equal, non-null labels are linked if the cosine of their vectors, in double
    precision, is at least ``limit`` (0 < limit <= 1). n_links counts the other rows linked
    directly, a repeated row too; component_id is the smallest id reachable by links, itself
    included, and kept says that it is the row's own. Vectors that are null, empty, zero or
    hold null or non-finite components link with nothing, nor do vectors of unequal length.
    A row without id links with nothing, has no component, and is kept. Further columns are
    not read; an empty table gives no row.

    ``most_bytes`` bounds the vectors of an interval; a pair of them is one row.
    """
    if not 0 < limit <= 1:
        raise ValueError("limit must be above 0 and at most 1")
    staged = Staged(vectors.sparkSession, "vectors")
    eps2 = 2 - 2 * limit + _SLACK
    rows = staged.write(classes_of(vectors, id_col, vec_col, label_col), "rows")
    classes = staged.write(rows.groupBy("label", "size", "vec").agg(F.min("id").alias("rep"), F.count("*").alias("weight")), "classes")
    axes = _axes(classes, sample)
    table = staged.write(_intervals(classes, axes, eps2**0.5, most_bytes), "intervals")
    # first whole ranges of the sequence, then their intervals
    corner = lambda f, c: F.array(*[f(F.col(c)[i]) for i in range(AXES)]).alias(c)
    boxes = table.groupBy("label", "size", "range").agg(corner(F.min, "low"), corner(F.max, "high"))
    near = boxes.alias("a").join(boxes.alias("b"), (F.col("a.label") == F.col("b.label")) & (F.col("a.size") == F.col("b.size")) & (F.col("a.range") <= F.col("b.range")) & _near("a", "b", eps2))
    near = near.select(F.col("a.label").alias("label"), F.col("a.size").alias("size"), F.col("a.range").alias("range_a"), F.col("b.range").alias("range_b"))
    small = table.select("label", "size", "range", "at", "low", "high")
    one, two = (small.select("label", "size", F.col("range").alias(f"range_{x}"), F.struct("at", "low", "high").alias(x)) for x in "ab")
    pairs = near.join(one, ["label", "size", "range_a"]).join(two, ["label", "size", "range_b"]).where(((F.col("range_a") < F.col("range_b")) | (F.col("a.at") <= F.col("b.at"))) & _near("a", "b", eps2))
    pairs = staged.write(pairs.select("range_a", F.col("a.at").alias("at_a"), "range_b", F.col("b.at").alias("at_b")), "pairs")
    full_a, full_b = (table.select(F.col("range").alias(f"range_{x}"), F.col("at").alias(f"at_{x}"), *(["size"] if x == "a" else []), *[F.col(c).alias(f"{c}_{x}") for c in ("rep", "weight", "vec")]) for x in "ab")
    own = (F.col("range_a") == F.col("range_b")) & (F.col("at_a") == F.col("at_b"))
    both = pairs.where(~own).join(full_a, ["range_a", "at_a"]).join(full_b, ["range_b", "at_b"])
    cols = ["size", "rep_a", "weight_a", "vec_a", "rep_b", "weight_b", "vec_b"]
    alone = full_a.select("size", "rep_a", "weight_a", "vec_a", *[F.lit(None).cast("binary").alias(c) for c in cols[4:]])
    found = staged.write(_joined(both.select(*cols).unionByName(alone), axes, limit), "found")
    staged.drop("intervals", "pairs")
    near_to = components(found.where("rep <> root").select(F.col("rep").alias("a"), F.col("root").alias("b")), staged, "c")
    linked = found.groupBy("rep").agg(F.sum("links").alias("links")).join(near_to, F.col("rep") == F.col("id"), "left").select("rep", "links", "component")
    told = classes.join(linked, "rep", "left").select("label", "size", "vec", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("links"), F.coalesce("component", "rep").alias("component"))
    good = rows.join(told, ["label", "size", "vec"]).select("id", "links", "component")
    # rows that share an id but not a vector are told apart by what they hold
    rest = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("string").alias("label"), F.col(vec_col).cast("array<double>").alias("v")).where(~_can_link()).select("id", F.lit(0).cast("long").alias("links"), F.col("id").alias("component"))
    return good.unionByName(rest).select(F.col("id").alias("vec_id"), F.col("links").alias("n_links"), F.col("component").alias("component_id"), F.coalesce(F.col("id") == F.col("component"), F.lit(True)).alias("kept"))


def _can_link() -> Column:
    """Whether (id, label, v) can link: the rows that classes_of gives."""
    whole = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0)
    return F.coalesce(F.col("id").isNotNull() & F.col("label").isNotNull() & (F.size("v") > 0) & whole, F.lit(False))
