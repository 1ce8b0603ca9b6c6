"""Bit planes against plain arithmetic, clusters against brute force."""

import hashlib
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerloom.llm import bitplanes, queries

# Extra columns carry names that the operators use inside.
SCHEMA = "vec_id long, embedding array<float>, label int, planes string, cluster int"


def odd_rows():
    rng = random.Random(4)
    vector = lambda spread=0.3: [float(np.float32(rng.gauss(0, spread))) for _ in range(64)]
    rows = [(i, vector(), rng.choice([None, 0, 1, 2])) for i in range(150)]
    rows += [(7, vector(), 1), (7, vector(), 1), rows[3], rows[3], (None, vector(), None), (None, vector(), 0)]
    rows += [(1000 + i, rows[20][1], 5) for i in range(60)]  # one very common vector
    rows += [(2000, [0.0] * 64, 3), (2001, [-0.0] * 64, 3), (2002, [-1 / 256] * 64, 3), (2003, vector(200.0), 3)]
    rows += [(3000, None, 1), (3001, [], 1), (3002, vector()[:63], 1), (3003, vector() + [0.0], 1),
             (3004, vector()[:63] + [None], 1), (3005, vector()[:63] + [float("nan")], 1),
             (3006, vector()[:63] + [float("inf")], 1), (3007, vector()[:63] + [float("-inf")], 1)]
    return [(*r, "p", 9) for r in rows]


@settings(max_examples=40, deadline=None)
@given(st.integers(0, 2**32 - 1), st.sampled_from([0, 1, 2, 255, 40_000, (1 << 24) - 1]),
       st.sampled_from([0, 1, 300, (1 << 24) - 1]))
def test_dot_products_are_exact(seed, spread, other):
    rng = np.random.default_rng(seed)
    a, b = rng.integers(-spread, spread + 1, (17, 64)), rng.integers(-other, other + 1, (5, 64))
    if seed % 3 == 0:
        a = np.abs(a)
    planes = [bitplanes.pack(x, bitplanes.planes_needed(int(x.min()), int(x.max()))) for x in (a, b)]
    assert (bitplanes.dots(*planes) == b @ a.T).all()
    assert (bitplanes.unpack(planes[0]) == a).all()


def test_planes_needed():
    for low, high, bits in ((0, 0, 1), (-1, 0, 1), (0, 1, 2), (-2, 1, 2), (-3, 1, 3), (-256, 255, 9), (0, 256, 10)):
        assert bitplanes.planes_needed(low, high) == bits


def reference(rows, centroids=bitplanes.CENTROIDS, rounds=bitplanes.ROUNDS):
    kept = [(i, v) for i, v, *_ in rows
            if v is not None and len(v) == 64 and None not in v and np.isfinite(v).all()]
    hashed = sorted(kept, key=lambda r: (r[0] is None, r[0] is not None and hashlib.sha256(f"2:{r[0]}".encode())
                                         .hexdigest(), r[1]))
    whole = lambda part: np.floor(256 * np.array([v for _, v in part], np.float64)).astype(np.int64)
    middle, values = whole(hashed[:centroids]), whole(kept)
    for step in range(rounds + 1):
        apart = ((values[:, None] - middle[None]) ** 2).sum(axis=-1)
        cluster, distance = apart.argmin(axis=1), apart.min(axis=1)
        if step < rounds:
            for c in set(cluster.tolist()):
                middle[c] = [int(s) // int((cluster == c).sum()) for s in values[cluster == c].sum(axis=0)]
    return sorted(((i, int(c), int(d), int(distance[cluster == c].sum()), int(distance.sum()),
                    hashlib.sha256(",".join(map(str, middle[c].tolist())).encode()).hexdigest())
                   for (i, _), c, d in zip(kept, cluster, distance)), key=str)


def test_clusters_equal_brute_force_on_odd_rows(spark):
    rows = odd_rows()
    got = bitplanes.clustered(spark.createDataFrame(rows, SCHEMA))
    assert got.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    assert sorted(map(tuple, got.collect()), key=str) == reference(rows)


def test_few_and_no_vectors(spark):
    rows = odd_rows()[:5]
    got = bitplanes.clustered(spark.createDataFrame(rows, SCHEMA))
    assert sorted(map(tuple, got.collect()), key=str) == reference(rows)
    none = bitplanes.clustered(spark.createDataFrame([(1, None, 2, "x", 3)], SCHEMA))
    assert none.columns == got.columns and none.isEmpty()


def test_whole_table_equals_brute_force(spark):
    import pyarrow.parquet as pq

    t = pq.read_table("/root/testdata/sf0.001/embeddings.parquet").to_pylist()
    got = queries.op12_centroid_clusters(spark, "/root/testdata/sf0.001")
    assert sorted(map(tuple, got.collect()), key=str) == reference([(r["vec_id"], r["embedding"]) for r in t])


def test_large_components_are_an_error(spark):
    with pytest.raises(ValueError, match="exact"):
        bitplanes.clustered(spark.createDataFrame([(1, [-65537.0] * 64, 0, "x", 3)], SCHEMA))
