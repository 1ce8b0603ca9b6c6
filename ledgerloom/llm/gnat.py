"""Product codes of vectors, with nearest entries found in a GNAT.

A codebook's entries form a geometric near-neighbour access tree. A node has a few split entries;
every other entry of the node lies below the split entry that is nearest to it, and for each split
and each child the node keeps the smallest and largest distance between them. A query first measures
the splits. With the best distance r so far, a child cannot hold a better entry if for some split
the query's distance less r exceeds the child's largest distance, or the query's distance plus r is
below its smallest. Such a subtree is left out only if that holds strictly after rounding every
distance to the safe side, so entries that tie are always met, and the squared distances that
decide are whole numbers. Queries go down the tree in batches.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import sized, stored
from ledgerloom.llm.vectors import decimal_sha256, floored_means, label_key, largest, usable, whole

DIMS, PARTS = 64, 16
ENTRIES, ROUNDS = 64, 2
SPLITS = 8
SHARPNESS = 5  # distances are rounded to 1/2^5
UNSEEN = np.iinfo(np.int64).max


def squared(queries: np.ndarray, points: np.ndarray) -> np.ndarray:
    """Squared distances (queries, points) of whole vectors."""
    total = np.zeros((len(queries), len(points)), np.int64)
    for axis in range(points.shape[1]):
        apart = queries[:, axis, None] - points[None, :, axis]
        total += apart * apart
    return total


def rounded(square: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distances in steps of 1/2^SHARPNESS, (rounded down, rounded up), from squared ones below 2^52."""
    wide = square << (2 * SHARPNESS)
    down = np.sqrt(wide.astype(np.float64)).astype(np.int64)
    down -= down * down > wide
    down += (down + 1) * (down + 1) <= wide
    return down, down + (down * down < wide)


@dataclass
class Node:
    """``splits`` are numbers of entries in ascending order; ``near`` and ``far`` hold the rounded
    distances between split i and the entries of child j, which is None if it has none."""

    splits: np.ndarray
    children: list = field(default_factory=list)
    near: np.ndarray | None = None
    far: np.ndarray | None = None


def build(entries: np.ndarray, among: np.ndarray | None = None) -> Node:
    """Tree over the entries numbered ``among``. Splits are chosen far from each other."""
    among = np.arange(len(entries)) if among is None else among
    if len(among) <= SPLITS:
        return Node(among)
    apart = squared(entries[among], entries[among])
    chosen, gap = [0], apart[0].copy()
    while len(chosen) < SPLITS:
        gap[chosen] = -1
        chosen.append(int(gap.argmax()))
        gap = np.minimum(gap, apart[chosen[-1]])
    chosen = np.sort(chosen)
    rest = np.setdiff1d(np.arange(len(among)), chosen)
    owner = apart[rest][:, chosen].argmin(axis=1)
    down, up = rounded(apart)
    node = Node(among[chosen], [], np.zeros((SPLITS, SPLITS), np.int64), np.zeros((SPLITS, SPLITS), np.int64))
    for j in range(SPLITS):
        below = rest[owner == j]
        node.children.append(build(entries, among[below]) if len(below) else None)
        if len(below):
            node.near[:, j] = down[np.ix_(chosen, below)].min(axis=1)
            node.far[:, j] = up[np.ix_(chosen, below)].max(axis=1)
    return node


def nearest(tree: Node, entries: np.ndarray, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(number of the nearest entry, squared distance) of each query; ties to the lower number."""
    best = np.full(len(queries), UNSEEN)
    code = np.zeros(len(queries), np.int64)

    def visit(node: Node, rows: np.ndarray) -> None:
        square = squared(queries[rows], entries[node.splits])
        first = square.argmin(axis=1)  # splits ascend, so the lowest of those that tie
        least, number = square[np.arange(len(rows)), first], node.splits[first]
        better = (least < best[rows]) | ((least == best[rows]) & (number < code[rows]))
        best[rows[better]], code[rows[better]] = least[better], number[better]
        if not node.children:
            return
        down, up = rounded(square)
        # The child of the nearest split first: it brings the best distance down for the others.
        for j, child in enumerate(node.children):
            if child is not None and len(own := np.flatnonzero(first == j)):
                visit(child, rows[own])
        for j, child in enumerate(node.children):
            if child is None:
                continue
            reach = rounded(best[rows])[1][:, None]
            out = (down - reach > node.far[:, j]) | (up + reach < node.near[:, j])
            left = np.flatnonzero((first != j) & ~out.any(axis=1))
            if len(left):
                visit(child, rows[left])

    if len(queries):
        visit(tree, np.arange(len(queries)))
    return code, best


def _parts(values: np.ndarray, parts: int) -> np.ndarray:
    return values.reshape(len(values), parts, -1)


def _codes(values: np.ndarray, books: np.ndarray, trees: list[Node]) -> tuple[np.ndarray, np.ndarray]:
    found = [nearest(tree, book, values[:, p]) for p, (book, tree) in enumerate(zip(books, trees))]
    return np.stack([c for c, _ in found], axis=1), np.stack([d for _, d in found], axis=1)


def _sums(books: np.ndarray):
    """Parts per entry and their sums by component, added up over a task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = [build(book) for book in books]
        parts, entries, width = books.shape
        count = np.zeros((parts, entries), np.int64)
        total = np.zeros(books.shape, np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            values = _parts(whole(batch.column("embedding"), parts * width), parts)
            codes, _ = _codes(values, books, trees)
            for p in range(parts):
                count[p] += np.bincount(codes[:, p], minlength=entries)
                for k in range(width):  # whole numbers far below 2^53: sums of doubles are exact
                    total[p, :, k] += np.bincount(codes[:, p], values[:, p, k], entries).astype(np.int64)
        part, entry = np.nonzero(count)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(x, width)) for x in (part, entry)]
            + [pa.array(np.tile(np.arange(width), len(part))), pa.array(np.repeat(count[part, entry], width)),
               pa.array(total[part, entry].reshape(-1))], ["part", "entry", "place", "n", "total"])
    return run


def _coded(books: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = [build(book) for book in books]
        parts, _, width = books.shape
        for batch in batches:
            if not batch.num_rows:
                continue
            values = _parts(whole(batch.column("embedding"), parts * width), parts)
            codes, squares = _codes(values, books, trees)
            text = codes.astype(np.uint8).tobytes().hex()
            size = 2 * parts
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("label"),
                 pa.array([text[i:i + size] for i in range(0, len(text), size)], pa.string()),
                 pa.array(squares.sum(axis=1))], ["vec_id", "label", "code", "error"])
    return run


def coded(embeddings: DataFrame, dims: int = DIMS, parts: int = PARTS, entries: int = ENTRIES,
          rounds: int = ROUNDS) -> DataFrame:
    """vec_id, code, error, label_error and codebooks_sha256 for every row of ``embeddings`` (vec_id,
    embedding, label) whose vector has ``dims`` components, none null or not finite.

    Entries start as the parts of the vectors with the smallest vec_ids; rows without vec_id come
    last, and rows with one vec_id are ordered by their components. With fewer vectors than
    ``entries`` a codebook has as many entries as there are vectors. Rows that repeat are rows each,
    entries that tie give the lower number, an unused entry stays as it is, and rows without label
    are one group. An empty table gives no rows, other columns are not read, and a component of
    65,536 or more is an error. Only codebooks and sums by entry reach the driver.
    """
    if dims % parts or not 0 < entries <= 256:
        raise ValueError("parts must divide dims, and entries must fit two hex digits")
    spark = embeddings.sparkSession
    kept = usable(embeddings.select("vec_id", "embedding", "label"), dims)
    id_type, label_type = (kept.schema[c].dataType.simpleString() for c in ("vec_id", "label"))
    largest(kept)
    first = kept.select("vec_id", "embedding").orderBy(F.col("vec_id").asc_nulls_last(), "embedding") \
        .limit(entries).collect()
    if not first:
        return spark.createDataFrame([], f"vec_id {id_type}, code string, error long, label_error long, "
                                         "codebooks_sha256 string")
    values = whole(pa.array([r["embedding"] for r in first], pa.list_(pa.float64())), dims)
    books = np.ascontiguousarray(_parts(values, parts).transpose(1, 0, 2))
    for _ in range(rounds):
        sums = kept.select("embedding").mapInArrow(
            _sums(books), "part long, entry long, place long, n long, total long")
        for (part, entry, place), (_, mean) in floored_means(sums, ["part", "entry", "place"]).items():
            books[part, entry, place] = mean
    found = stored(kept.mapInArrow(_coded(books), f"vec_id {id_type}, label {label_type}, code string, "
                                                  "error long"), "codes")
    own = found.groupBy(label_key(F.col("label")).alias("key")).agg(F.sum("error").alias("label_error"))
    own = sized(own, own.count(), 64)
    return found.withColumn("key", label_key(F.col("label"))).join(own, "key").select(
        "vec_id", "code", "error", "label_error",
        F.lit(decimal_sha256(books.reshape(-1))).alias("codebooks_sha256"))


def oracle(parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, dims: int = DIMS) -> str:
    """DuckDB SQL for ``coded`` over ``embeddings``."""
    width = dims // parts
    distance = " + ".join(f"(x[{k}] - e[{k}]) * (x[{k}] - e[{k}])" for k in range(1, width + 1))
    steps = [f"""
    v AS MATERIALIZED (
        SELECT vec_id, label, row_number() OVER () AS rid,
               list_transform(embedding, lambda e: CAST(floor(256 * CAST(e AS DOUBLE)) AS BIGINT)) AS y
        FROM embeddings WHERE len(embedding) = {dims}
            AND len(list_filter(embedding, lambda e: isfinite(e))) = {dims}),
    p AS MATERIALIZED (
        SELECT rid, vec_id, part, y[part * {width} + 1 : part * {width} + {width}] AS x
        FROM v, (SELECT unnest(range({parts})) AS part)),
    b0 AS MATERIALIZED (
        SELECT part, entry, x AS e FROM p JOIN (
            SELECT rid, row_number() OVER (ORDER BY vec_id NULLS LAST, y) - 1 AS entry FROM v
            QUALIFY entry < {entries}) USING (rid))"""]
    for i in range(rounds + 1):
        steps.append(f"""
    a{i} AS MATERIALIZED (
        SELECT rid, part, any_value(x) AS x, min({{'d': {distance}, 'entry': entry}}) AS near
        FROM p JOIN b{i} USING (part) GROUP BY rid, part)""")
        if i < rounds:
            steps.append(f"""
    m{i} AS (
        SELECT part, entry, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY place) AS e
        FROM (SELECT part, near.entry AS entry, place, sum(x[place]) AS s, count(*) AS n
              FROM a{i}, (SELECT unnest(range(1, {width + 1})) AS place) GROUP BY ALL)
        GROUP BY part, entry),
    b{i + 1} AS MATERIALIZED (
        SELECT part, entry, coalesce(m{i}.e, b{i}.e) AS e FROM b{i} LEFT JOIN m{i} USING (part, entry))""")
    return f"""WITH {", ".join(steps)},
    r AS (SELECT rid, string_agg(printf('%02x', near.entry), '' ORDER BY part) AS code,
                 CAST(sum(near.d) AS BIGINT) AS error FROM a{rounds} GROUP BY rid)
    SELECT vec_id, code, error,
           CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
           (SELECT sha256(string_agg(array_to_string(e, ','), ',' ORDER BY part, entry)) FROM b{rounds})
               AS codebooks_sha256
    FROM r JOIN v USING (rid)"""
