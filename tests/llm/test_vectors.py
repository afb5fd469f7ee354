import numpy as np
import pytest
from pyspark.sql import functions as F

from isoloom.llm import queries, vectors
from isoloom.llm.common import Staged
from isoloom.llm.components import components

from .conftest import SMALL


def brute(rows, limit=0.98):
    """(vec_id, n_links, component, kept) of (vec_id, vector, label) rows, all pairs compared."""
    n = len(rows)
    ok = [i is not None and label is not None and v is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v) and any(v) for i, v, label in rows]
    unit = [np.array(v, float) / np.linalg.norm(v) if good else None for (_, v, _), good in zip(rows, ok)]
    near = [[b for b in range(n) if b != a and ok[a] and ok[b] and rows[a][2] == rows[b][2] and len(unit[a]) == len(unit[b]) and (unit[a] @ unit[b] >= limit or np.array_equal(rows[a][1], rows[b][1]))] for a in range(n)]
    out = []
    for a in range(n):
        seen, todo = {a}, [a]
        while todo:
            new = [b for b in near[todo.pop()] if b not in seen]
            seen.update(new)
            todo += new
        least = min(rows[b][0] for b in seen) if ok[a] else rows[a][0]
        out.append((rows[a][0], len(near[a]), least, rows[a][0] is None or rows[a][0] == least))
    return sorted(out, key=str)


def made(n, seed=3, size=12):
    """Chains of near vectors, clusters, copies and loners under three labels."""
    rng = np.random.default_rng(seed)
    out, at = [], rng.normal(size=size)
    for i in range(n):
        kind = rng.integers(5)
        if kind == 0:
            at = rng.normal(size=size)
        elif kind == 1:
            at = at + 0.04 * rng.normal(size=size) * np.linalg.norm(at) / size**0.5 * 4  # some way on
        v = at * rng.uniform(0.5, 2) + (0 if kind == 2 else 0.02 * np.linalg.norm(at) / size**0.5 * rng.normal(size=size))
        out.append((int(i * 7 % n), [float(np.float32(x)) for x in v], int(rng.integers(3)) if kind != 3 else 1))
    return out


SCHEMA = "vec_id long, embedding array<float>, label int"


def ours(df, **how):
    return sorted((tuple(r) for r in vectors.links(df, **how).collect()), key=str)


def test_against_all_pairs(spark):
    rows = made(500)
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    assert ours(df) == brute(rows)
    # many small intervals: joined over ranges and intervals alike
    assert ours(df, most_bytes=1600) == brute(rows)
    assert ours(df, limit=0.9, most_bytes=1600, sample=20) == brute(rows, 0.9)


def test_one_large_group(spark, monkeypatch):
    """A third of the rows equal, a third near each other, under one label; small leaves."""
    monkeypatch.setattr(vectors, "LEAF", 16)
    rng = np.random.default_rng(1)
    base = rng.normal(size=8)
    rows = [(i, [float(np.float32(x)) for x in (base if i % 3 == 0 else base + 0.1 * rng.normal(size=8) if i % 3 == 1 else rng.normal(size=8))], 1) for i in range(360)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    assert ours(df, most_bytes=2000) == brute(rows)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0], 1), (1, [1.0, 0.0], 1), (2, [2.0, -0.0], 1), (3, [1.0, 0.0], None), (4, [1.0, 0.0], None), (5, None, 1), (6, [], 1), (7, [0.0, 0.0], 1), (8, [1.0, None], 1), (9, [nan, 1.0], 1), (10, [inf, 0.0], 1), (None, [1.0, 0.0], 1), (11, [1.0, 0.0, 0.0], 1), (12, [1.0, 0.1], 1), (13, [-1.0, 0.0], 1), (14, [1e-30, 0.0], 1), (15, [1e30, 1e29], 1), (16, [1.0, 0.0], 2), (16, [0.0, 1.0], 2)]
    df = spark.createDataFrame(rows, SCHEMA)
    want = brute([(i, v, x) if i != 15 else (i, [1.0, 0.1], x) for i, v, x in rows])
    assert ours(df) == want
    # columns of the same names as the operator's own, and an empty table
    more = df.withColumn("id", F.lit("x")).withColumn("rep", F.lit(1)).withColumn("a.b", F.lit(2)).withColumn("size", F.lit(None))
    assert ours(more) == want
    assert ours(df.limit(0)) == []
    with pytest.raises(ValueError):
        vectors.links(df, limit=0)


def test_components(spark):
    """Empty edges, self loops, chains, repeated edges."""
    staged = Staged(spark, "test")
    frame = lambda e: spark.createDataFrame(e, "a long, b long")
    assert components(frame([]), staged, "none").count() == 0
    assert components(frame([(5, 5)]), staged, "loop").count() == 0
    chain = [(i, i + 1) for i in range(20, 40)] + [(3, 2), (2, 3), (3, 3), (9, 3)]
    got = {tuple(r) for r in components(frame(chain), staged, "chain").collect()}
    assert got == {(i, 20) for i in range(20, 41)} | {(i, 2) for i in (2, 3, 9)}


def test_skips_what_is_far():
    """Only boxes within reach are multiplied out."""
    x = np.concatenate([np.tile([1.0, 0.0], (300, 1)), np.tile([0.0, 1.0], (300, 1))])
    done = []

    class Seen(vectors.Joined):
        def leaf(self, *at):
            done.append(at)
            super().leaf(*at)

    found = Seen((x, np.ones(600, np.int64)), None, np.eye(2), 0.98).found()
    assert (found[1] == 299).all() and set(found[2]) == {0, 300}
    assert all((i < 300) == (k < 300) for i, j, k, m in done if j <= 300 and i >= 0 and m <= 300)
    assert not any(j <= 300 and k >= 300 for i, j, k, m in done)


def test_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    out = queries.op12_embedding_links(spark, SMALL)
    assert out.dtypes == [("vec_id", "bigint"), ("n_links", "bigint"), ("component_id", "bigint"), ("kept", "boolean")]
    assert sorted((tuple(r) for r in out.collect()), key=str) == brute(rows)
