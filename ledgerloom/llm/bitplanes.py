"""Centroid clustering with distances by bit planes.

A vector has 64 whole components. Bit b of all of them, in two's complement, is one 64-bit word, the
vector's plane b. The dot product of two vectors is the sum, over pairs of their planes a and b, of
2^(a+b) times the number of bits set in both; pairs with one sign plane count negatively. Squared
distances follow from dot products and squared lengths, all in whole numbers. Vectors are packed once
and stored, and each round reads the planes only.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import stored
from ledgerloom.llm.vectors import decimal_sha256, floored_means, largest, usable, whole

DIMS = 64
CENTROIDS, ROUNDS, SEED = 40, 5, "2:"
ROWS_AT_ONCE = 1024  # rows times centroids of counts stay in a core's cache


def planes_needed(low: int, high: int) -> int:
    """Bits of two's complement that hold both numbers, the sign included."""
    return max((low if low >= 0 else ~low).bit_length(), (high if high >= 0 else ~high).bit_length()) + 1


def pack(values: np.ndarray, planes: int) -> np.ndarray:
    """Planes of vectors (rows of 64 whole numbers): unsigned 64-bit words, (planes, rows)."""
    packed = [np.packbits(((values >> b) & 1).astype(np.uint8), axis=1, bitorder="little")
              for b in range(planes)]
    return np.stack([p.view("<u8").reshape(-1) for p in packed])


def unpack(planes: np.ndarray) -> np.ndarray:
    """The vectors that ``pack`` was given."""
    values = np.zeros((planes.shape[1], DIMS), np.int64)
    for b, words in enumerate(planes):
        bits = np.unpackbits(np.ascontiguousarray(words).view(np.uint8).reshape(-1, 8), axis=1,
                             bitorder="little").astype(np.int64)
        values += -(bits << b) if b == len(planes) - 1 else bits << b
    return values


def dots(rows: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Exact dot products (centroids, rows) of vectors given as planes."""
    last_row, last_centroid = len(rows) - 1, len(centroids) - 1
    # Pairs of planes with one weight and sign are counted together.
    groups = defaultdict(list)
    for a in range(len(rows)):
        for b in range(len(centroids)):
            groups[a + b, (a == last_row) != (b == last_centroid)].append((a, b))
    shape = centroids.shape[1], rows.shape[1]
    both, bits = np.empty(shape, np.uint64), np.empty(shape, np.uint8)
    total = np.zeros(shape, np.int64)
    for (power, negative), pairs in groups.items():
        counts = np.zeros(shape, np.uint16)  # at most 64 bits in each of fewer than 1000 pairs
        for a, b in pairs:
            np.bitwise_and(centroids[b][:, None], rows[a][None, :], out=both)
            counts += np.bitwise_count(both, out=bits)
        weighted = counts.astype(np.int64) << power
        total += -weighted if negative else weighted
    return total


def nearest(rows: np.ndarray, squares: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(number of the nearest centroid, squared distance) of each row; ties to the smaller number.
    ``rows`` are planes, ``squares`` their squared lengths, ``centroids`` whole numbers."""
    planes = pack(centroids, planes_needed(int(centroids.min()), int(centroids.max())))
    own = (centroids * centroids).sum(axis=1)
    cluster = np.empty(rows.shape[1], np.int64)
    distance = np.empty(rows.shape[1], np.int64)
    for at in range(0, rows.shape[1], ROWS_AT_ONCE):
        part = slice(at, at + ROWS_AT_ONCE)
        far = own[:, None] + squares[None, part] - 2 * dots(rows[:, part], planes)
        cluster[part] = far.argmin(axis=0)
        distance[part] = far.min(axis=0)
    return cluster, distance


def _packed(planes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = whole(batch.column("embedding"), DIMS)
            words = np.ascontiguousarray(pack(values, planes).T).view(np.int64).reshape(-1)
            ends = np.arange(len(values) + 1, dtype=np.int32) * planes
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), pa.ListArray.from_arrays(ends, words),
                 pa.array((values * values).sum(axis=1))], ["vec_id", "planes", "square"])
    return run


def _planes(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    words = batch.column("planes").flatten().to_numpy(zero_copy_only=False).view(np.uint64)
    return (np.ascontiguousarray(words.reshape(batch.num_rows, -1).T),
            batch.column("square").to_numpy(zero_copy_only=False))


def _sums(centroids: np.ndarray):
    """Rows per cluster and their sums by component, added up over a task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = np.zeros(len(centroids), np.int64)
        total = np.zeros((len(centroids), DIMS), np.int64)
        for batch in batches:
            if batch.num_rows:
                planes, squares = _planes(batch)
                cluster, _ = nearest(planes, squares, centroids)
                # Whole numbers far below 2^53: sums of doubles are exact.
                member = (np.arange(len(centroids))[:, None] == cluster[None, :]).astype(np.float64)
                total += (member @ unpack(planes).astype(np.float64)).astype(np.int64)
                count += member.sum(axis=1).astype(np.int64)
        used = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(used, DIMS)), pa.array(np.tile(np.arange(DIMS), len(used))),
             pa.array(np.repeat(count[used], DIMS)), pa.array(total[used].reshape(-1))],
            ["cluster", "place", "n", "total"])
    return run


def _assigned(centroids: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                cluster, distance = nearest(*_planes(batch), centroids)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("vec_id"), pa.array(cluster.astype(np.int32)), pa.array(distance)],
                    ["vec_id", "cluster", "distance"])
    return run


def starts(kept: DataFrame, centroids: int, seed: str) -> np.ndarray:
    """The vectors with the smallest hashes of their ids."""
    place = F.sha2(F.concat(F.lit(seed), F.col("vec_id").cast("string")), 256)
    rows = kept.select("embedding", place.alias("place")) \
        .orderBy(F.col("place").asc_nulls_last(), "embedding").limit(centroids).collect()
    return whole(pa.array([r["embedding"] for r in rows], pa.list_(pa.float64())), DIMS)


def clustered(embeddings: DataFrame, centroids: int = CENTROIDS, rounds: int = ROUNDS,
              seed: str = SEED) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia and centroid_sha256 for every row of
    ``embeddings`` (vec_id, embedding) whose vector has 64 components, none null or not finite.

    Centroids start as the vectors with the smallest SHA-256 of seed and vec_id; rows without vec_id
    come last, and rows with one vec_id are ordered by their components. With fewer vectors than
    centroids there are as many centroids as vectors. Rows that repeat are rows each; nearest
    centroids that tie give the smaller number; a centroid without vectors stays as it is. An
    empty table gives no rows, other columns are not read, and a component of 65,536 or more is an
    error. Only centroids and their sums reach the driver.
    """
    spark = embeddings.sparkSession
    kept = usable(embeddings.select("vec_id", "embedding"), DIMS)
    low, high = largest(kept)
    middle = starts(kept, centroids, seed)
    if not len(middle):
        return spark.createDataFrame(
            [], "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, "
                "centroid_sha256 string")
    id_type = kept.schema["vec_id"].dataType.simpleString()
    packed = stored(kept.mapInArrow(_packed(planes_needed(low, high)),
                                    f"vec_id {id_type}, planes array<long>, square long"), "planes")
    for _ in range(rounds):
        sums = packed.mapInArrow(_sums(middle), "cluster long, place long, n long, total long")
        for (cluster, place), (_, mean) in floored_means(sums, ["cluster", "place"]).items():
            middle[cluster, place] = mean
    found = stored(packed.mapInArrow(_assigned(middle), f"vec_id {id_type}, cluster int, distance long"),
                   "clusters")
    own = {r["cluster"]: r["total"] for r in
           found.groupBy("cluster").agg(F.sum("distance").alias("total")).collect()}
    facts = spark.createDataFrame(
        [(c, own[c], sum(own.values()), decimal_sha256(middle[c])) for c in sorted(own)],
        "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return found.join(F.broadcast(facts), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def oracle(centroids: int = CENTROIDS, rounds: int = ROUNDS, seed: str = SEED) -> str:
    """DuckDB SQL for ``clustered`` over ``embeddings``."""
    distance = "list_sum(list_transform(range(1, 65), lambda i: (x[i] - c[i]) * (x[i] - c[i])))"
    steps = [f"""
    v AS MATERIALIZED (
        SELECT vec_id, row_number() OVER () AS rid,
               list_transform(embedding, lambda e: CAST(floor(256 * CAST(e AS DOUBLE)) AS BIGINT)) AS x
        FROM embeddings WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda e: isfinite(e))) = 64),
    c0 AS MATERIALIZED (
        SELECT row_number() OVER (ORDER BY sha256('{seed}' || vec_id) NULLS LAST, x) - 1 AS cluster, x AS c
        FROM v QUALIFY cluster < {centroids})"""]
    for i in range(rounds + 1):
        steps.append(f"""
    a{i} AS MATERIALIZED (
        SELECT rid, any_value(vec_id) AS vec_id, any_value(x) AS x,
               min({{'d': CAST({distance} AS BIGINT), 'cluster': cluster}}) AS near
        FROM v, c{i} GROUP BY rid)""")
        if i < rounds:
            steps.append(f"""
    m{i} AS (
        SELECT cluster, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY place) AS c
        FROM (SELECT near.cluster AS cluster, place, sum(x[place]) AS s, count(*) AS n
              FROM a{i}, (SELECT unnest(range(1, 65)) AS place) GROUP BY ALL) GROUP BY cluster),
    c{i + 1} AS MATERIALIZED (
        SELECT cluster, coalesce(m{i}.c, c{i}.c) AS c FROM c{i} LEFT JOIN m{i} USING (cluster))""")
    return f"""WITH {", ".join(steps)}
    SELECT vec_id, CAST(near.cluster AS INTEGER) AS cluster, near.d AS distance,
           CAST(sum(near.d) OVER (PARTITION BY near.cluster) AS BIGINT) AS cluster_inertia,
           CAST(sum(near.d) OVER () AS BIGINT) AS inertia,
           sha256(array_to_string(c, ',')) AS centroid_sha256
    FROM a{rounds} JOIN c{rounds} ON near.cluster = c{rounds}.cluster"""
