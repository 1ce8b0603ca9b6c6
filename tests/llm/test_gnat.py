"""Product codes against brute force, the tree against a full search."""

import hashlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerloom.llm import gnat, queries, vectors
from test_bitplanes import SCHEMA, odd_rows


def brute(entries, queries_):
    apart = ((queries_[:, None].astype(object) - entries[None].astype(object)) ** 2).sum(axis=-1)
    return apart.argmin(axis=1), apart.min(axis=1)


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 2**32 - 1), st.integers(1, 64), st.sampled_from([1, 3, 40, 3000, (1 << 23) - 1]))
def test_tree_finds_the_lowest_of_the_nearest(seed, size, spread):
    rng = np.random.default_rng(seed)
    entries = rng.integers(-spread, spread + 1, (size, 4))
    asked = rng.integers(-spread, spread + 1, (200, 4))
    asked[:size] = entries[:200]  # distance zero, and ties where entries repeat
    code, square = gnat.nearest(gnat.build(entries), entries, asked)
    want, least = brute(entries, asked)
    assert (code == want).all() and (square == least).all()


def test_a_tree_leaves_out_subtrees():
    rng = np.random.default_rng(1)
    entries = np.concatenate([rng.integers(0, 30, (8, 4)) + 1000 * k for k in range(8)])
    tree = gnat.build(entries)
    visited = []
    original = gnat.squared
    gnat.squared = lambda q, p: visited.append(len(q) * len(p)) or original(q, p)
    try:
        gnat.nearest(tree, entries, entries)
    finally:
        gnat.squared = original
    assert sum(visited) < 64 * 64 / 2


def test_rounding_encloses_every_distance():
    square = np.concatenate([np.arange(5000), 2**52 - 1 - np.arange(5000), np.arange(3000) ** 2])
    down, up = gnat.rounded(square)
    wide = square.astype(object) * 4**gnat.SHARPNESS
    assert (down.astype(object) ** 2 <= wide).all() and (up.astype(object) ** 2 >= wide).all()
    assert (up - down <= 1).all() and ((down == up) == (down.astype(object) ** 2 == wide)).all()


def reference(rows, entries=gnat.ENTRIES, rounds=gnat.ROUNDS):
    kept = sorted(((i, v, label) for i, v, label, *_ in rows
                   if v is not None and len(v) == 64 and None not in v and np.isfinite(v).all()),
                  key=lambda r: (r[0] is None, r[0], r[1]))
    whole = np.floor(256 * np.array([v for _, v, _ in kept], np.float64)).astype(np.int64).reshape(-1, 16, 4)
    books = whole[:entries].transpose(1, 0, 2).copy()
    for _ in range(rounds):
        for p in range(16):
            code, _ = brute(books[p], whole[:, p])
            for e in set(code.tolist()):
                books[p, e] = [int(s) // int((code == e).sum()) for s in whole[code == e, p].sum(axis=0)]
    found = [brute(books[p], whole[:, p]) for p in range(16)]
    digest = hashlib.sha256(",".join(map(str, books.reshape(-1).tolist())).encode()).hexdigest()
    error = [sum(int(d[i]) for _, d in found) for i in range(len(kept))]
    total = {}
    for (_, _, label), e in zip(kept, error):
        total[label] = total.get(label, 0) + e
    return sorted(((i, "".join(f"{int(c[k]):02x}" for c, _ in found), error[k], total[label], digest)
                   for k, (i, _, label) in enumerate(kept)), key=str)


def test_codes_equal_brute_force_on_odd_rows(spark):
    rows = odd_rows()
    got = gnat.coded(spark.createDataFrame(rows, SCHEMA))
    assert got.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    assert sorted(map(tuple, got.collect()), key=str) == reference(rows)


def test_few_and_no_vectors(spark):
    rows = odd_rows()[:5]
    assert sorted(map(tuple, gnat.coded(spark.createDataFrame(rows, SCHEMA)).collect()), key=str) == reference(rows)
    none = gnat.coded(spark.createDataFrame([(1, None, 2, "x", 3)], SCHEMA))
    assert none.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"] and none.isEmpty()


def test_whole_table_equals_brute_force(spark):
    import pyarrow.parquet as pq

    t = pq.read_table("/root/testdata/sf0.001/embeddings.parquet").to_pylist()
    rows = [(r["vec_id"], r["embedding"], r["label"]) for r in t]
    got = queries.op11_vector_codes(spark, "/root/testdata/sf0.001")
    assert sorted(map(tuple, got.collect()), key=str) == reference(rows)


def test_large_components_are_an_error(spark):
    with pytest.raises(ValueError, match="exact"):
        gnat.coded(spark.createDataFrame([(1, [65536.0] * 64, 0, "x", 3)], SCHEMA))
    assert vectors.LARGEST == 65536 * vectors.SCALE
