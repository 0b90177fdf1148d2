"""Centroids and exact search over vectors against plain versions."""

import hashlib
import math

import numpy as np
import pyarrow as pa
import pytest
from compare import compare, connect
from pyspark.sql import functions as F

from sparkkit.llm import centroids, search
from sparkkit.llm.queries import ORACLE, QUERIES

SMALL = "/root/testdata/sf0.001"
ROWS = "vec_id long, embedding array<float>, cluster string, q int, row string"


def usable(v):
    return v is not None and all(x is not None and math.isfinite(x) for x in v)


def whole(v):
    return [math.floor(256 * float(np.float32(x))) for x in v]


def plain_clusters(rows, k, rounds, size):
    kept = [(i, whole(v)) for i, v in rows if usable(v) and len(v) == size]
    mark = lambda i: hashlib.sha256(f"2:{'' if i is None else i}".encode()).hexdigest()
    middle = [q for _, q in sorted(kept, key=lambda r: (mark(r[0]), r[1]))[:k]]
    far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    for n in range(rounds + 1):
        near = [min((far(q, m), c) for c, m in enumerate(middle)) for _, q in kept]
        if n == rounds:
            return middle, sorted(((i, c, d) for (i, _), (d, c) in zip(kept, near)), key=repr)
        for c in range(len(middle)):
            if own := [q for (_, q), (_, x) in zip(kept, near) if x == c]:
                middle[c] = [sum(column) // len(own) for column in zip(*own)]


def plain_search(rows, k):
    kept = [(n, i, whole(v)) for n, (i, v) in enumerate(rows) if usable(v)]
    out = []
    for n, i, q in kept:
        if i is None or i % 50:
            continue
        scored = [(-sum(a * b for a, b in zip(q, other)), j is None, j or 0) for m, j, other in kept if m != n]
        out += [(i, rank, None if null else j, -score) for rank, (score, null, j) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=repr)


def vectors(seed, n, size, spread=0.3):
    """Random vectors with repeated rows, ties, equal and zero vectors, null ids and everything that takes no part."""
    draw = np.random.default_rng(seed)
    rows = [(j, (draw.normal(0, spread, size) * (draw.random(size) < 0.7)).astype(np.float32).tolist()) for j in range(n)]
    rows += [(7, rows[7][1]), (100, rows[100][1]), (n, rows[100][1]), (n + 1, [0.0] * size), (None, rows[3][1]), (None, rows[50][1])]
    rows += [(n + 2, None), (n + 3, [None] * size), (50 * n, [0.5] * (size - 1) + [math.nan]), (n + 5, [math.inf] + [0.5] * (size - 1))]
    rows += [(n + 6, [0.25] * (size - 1)), (50 * n + 50, [-0.75] * (size + 1)), (n + 8, [])]
    return rows


def frame(spark, rows, parts=4):
    return spark.createDataFrame([(i, v, "x", 1, "y") for i, v in rows], ROWS).repartition(parts)


@pytest.mark.parametrize("k, rounds, size", [(5, 3, 4), (40, 5, 8), (1, 1, 3)])
def test_clusters_as_in_plain_python(spark, k, rounds, size):
    rows = vectors(k, 300, size)
    found = centroids.cluster(frame(spark, rows), k, rounds, size)
    middle, members = plain_clusters(rows, k, rounds, size)
    assert found.centroids.tolist() == middle
    assert sorted(map(tuple, found.members.collect()), key=repr) == members
    sums = {c: sum(d for _, x, d in members if x == c) for c in {c for _, c, _ in members}}
    assert found.inertias() == sums


def test_clusters_of_few_equal_and_no_vectors(spark):
    rows = [(1, [0.5, -0.5])] * 3 + [(2, [0.1, 0.1])]
    found = centroids.cluster(frame(spark, rows), 40, 5, 2)
    assert found.centroids.tolist() == plain_clusters(rows, 40, 5, 2)[0] and found.members.count() == 4
    none = centroids.cluster(frame(spark, [(1, None), (2, [1.0])]), 40, 5, 2)
    assert none.members.collect() == [] and none.inertias() == {}


def test_ties_go_to_the_first_centroid(spark):
    occurring = centroids.occurring_numbers(np.array([[0, 5], [4, 5]]))
    cluster, distance = centroids.nearest(occurring, np.array([[2, 5], [-2, 5], [6, 5]]))
    assert cluster.tolist() == [0, 0] and distance.tolist() == [4, 4]


def test_too_large_components_are_told(spark):
    with pytest.raises(Exception, match="after scaling"):
        centroids.cluster(frame(spark, [(1, [1e30, 0.0])]), 2, 1, 2).members.count()


@pytest.mark.parametrize("k, size, shards", [(5, 8, 1), (5, 3, 4), (1, 16, 2), (700, 4, 3)])
def test_search_as_in_plain_python(spark, k, size, shards):
    rows = vectors(size, 400, size)
    found = search.top_products(frame(spark, rows, shards), F.col("vec_id") % 50 == 0, k)
    assert sorted(map(tuple, found.collect()), key=repr) == plain_search(rows, k)


def test_search_in_blocks_of_queries(spark):
    rows = vectors(1, 400, 6)
    found = search.top_products(frame(spark, rows), F.col("vec_id") % 50 == 0, 5, block=12)
    assert sorted(map(tuple, found.collect()), key=repr) == plain_search(rows, 5)


def test_search_with_only_negative_and_no_candidates(spark):
    rows = [(0, [1.0, 1.0]), (1, [-1.0, -1.0]), (2, [-1.0, -0.5]), (3, [-1.0, -0.5])]
    condition = F.col("vec_id") % 50 == 0
    assert sorted(map(tuple, search.top_products(frame(spark, rows), condition, 2).collect())) == plain_search(rows, 2)
    assert search.top_products(frame(spark, rows[:1]), condition).collect() == []
    assert search.top_products(frame(spark, rows[1:]), condition).collect() == []


def test_what_search_leaves_out_is_below_the_threshold():
    """Essential lists and probes against full products, for thresholds of every kind."""
    draw = np.random.default_rng(3)
    q = draw.integers(-40, 40, (500, 12)) * (draw.random((500, 12)) < 0.6)
    shard = search.Shard(np.arange(500), pa.array(range(500)), np.arange(501) * 12, q.ravel())
    probes = 0
    for own in range(0, 500, 25):
        full = q @ q[own]
        full[own] = np.iinfo(np.int64).min
        best = np.sort(full)[::-1]
        for threshold in (None, int(best[0]) + 1, int(best[4]), int(best[200]), -10**6, 0):
            alive, score = shard.search(own, q[own], 5, threshold)
            assert (score == full[alive]).all()
            least = best[4] if threshold is None else threshold
            assert set(np.flatnonzero(full >= least)) - {own} <= set(alive.tolist())
            probes += len(alive) < 50
    assert probes >= 40  # most vectors are never finished


@pytest.mark.parametrize("name", ["op11_centroids", "op13_max_score"])
def test_queries(spark, small, name):
    assert compare(QUERIES[name](spark, SMALL), ORACLE[name], connect(SMALL)).startswith("same (")
