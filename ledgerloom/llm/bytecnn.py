"""Quality of texts by a convolutional network over bytes, in numpy.

The UTF-8 bytes of a whole text are covered by overlapping chunks. Each byte has a learned vector;
learned filters slide over the chunk, and each filter keeps its largest response in the chunk. A
hidden layer sees a chunk's responses, and the text is judged by the largest and the mean value of
each hidden unit over its chunks. As a filter is a sum over its places of a table by byte, a response
is a sum of looked-up rows, without any multiplication.

The network is fitted on the driver to a bounded sample of labelled texts; scoring uses all bytes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CHUNK, STEP = 256, 192  # bytes; neighbours share more than a filter is wide
WIDTH, FILTERS, BYTE_DIMS, HIDDEN = 6, 32, 8, 16
THRESHOLD = 0.3
#: Bounds of the training sample: labelled documents, those with the smallest hashes, and chunks of
#: each, evenly spread over the whole document.
SAMPLE_DOCS, SAMPLE_CHUNKS = 2000, 64
EPOCHS, BATCH, RATE = 6, 32, 0.004
CHUNKS_AT_ONCE = 32  # responses of so many chunks stay in a core's cache


def held_out(doc_id: Column) -> Column:
    """Documents kept from training: crc32 of the id as text is divisible by 5."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def chunks(raw: bytes) -> np.ndarray:
    """Overlapping chunks, one row each, that cover all bytes; zeros fill the last one. An empty
    text has one chunk of zeros."""
    count = 1 + max(0, -(-(len(raw) - CHUNK) // STEP))
    padded = np.zeros((count - 1) * STEP + CHUNK, np.uint8)
    padded[:len(raw)] = np.frombuffer(raw, np.uint8)
    return np.lib.stride_tricks.sliding_window_view(padded, CHUNK)[::STEP]


def fresh(seed: int = 0) -> dict[str, np.ndarray]:
    """An untrained network; its last layer starts at zero, so every text has a score of one half."""
    rng = np.random.default_rng(seed)
    shapes = {"bytes": (0.5, (256, BYTE_DIMS)), "filters": (0.3, (WIDTH, BYTE_DIMS, FILTERS)),
              "filter_bias": (0, FILTERS), "hidden": (0.2, (FILTERS, HIDDEN)), "hidden_bias": (0, HIDDEN),
              "last": (0, 2 * HIDDEN), "last_bias": (0, 1)}
    return {name: (spread * rng.standard_normal(shape)).astype(np.float32)
            for name, (spread, shape) in shapes.items()}


def tables(net: dict[str, np.ndarray]) -> np.ndarray:
    """What each byte adds to each filter at each place: (place, byte, filter)."""
    return np.einsum("be,wef->wbf", net["bytes"], net["filters"]).astype(net["bytes"].dtype)


def responses(rows: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The largest response of each filter in each chunk, and where it is."""
    places = rows.shape[1] - WIDTH + 1
    best = np.empty((len(rows), table.shape[2]), table.dtype)
    where = np.empty(best.shape, np.int64)
    total = np.empty((CHUNKS_AT_ONCE, places, table.shape[2]), table.dtype)
    added = np.empty_like(total)
    for at in range(0, len(rows), CHUNKS_AT_ONCE):
        part = rows[at:at + CHUNKS_AT_ONCE]
        n = len(part)
        np.take(table[0], part[:, :places], axis=0, out=total[:n], mode="clip")
        for k in range(1, WIDTH):
            np.take(table[k], part[:, k:k + places], axis=0, out=added[:n], mode="clip")
            total[:n] += added[:n]
        where[at:at + n] = total[:n].argmax(axis=1)
        best[at:at + n] = total[:n].max(axis=1)
    return best, where


def hidden_units(net: dict[str, np.ndarray], best: np.ndarray) -> np.ndarray:
    seen = np.maximum(best + net["filter_bias"], 0)
    return np.maximum(seen @ net["hidden"] + net["hidden_bias"], 0)


def probability(logit: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(logit.astype(np.float64), -40, 40)))


def gradients(net: dict[str, np.ndarray], rows: np.ndarray, owner: np.ndarray, wanted: np.ndarray
              ) -> tuple[float, dict[str, np.ndarray]]:
    """Mean log loss of texts and its gradient. ``rows`` are chunks, ``owner`` the ascending number of
    the text of each; every text has a chunk."""
    best, where = responses(rows, tables(net))
    seen = np.maximum(best + net["filter_bias"], 0)
    unit = np.maximum(seen @ net["hidden"] + net["hidden_bias"], 0)
    start = np.flatnonzero(np.diff(owner, prepend=-1))
    count = np.bincount(owner)[:, None].astype(unit.dtype)
    top = np.maximum.reduceat(unit, start, axis=0)
    features = np.concatenate([top, np.add.reduceat(unit, start, axis=0) / count], axis=1)
    logit = features @ net["last"] + net["last_bias"]
    p = probability(logit)
    loss = -np.mean(np.log(np.where(wanted == 1, p, 1 - p)))

    d_logit = ((p - wanted) / len(wanted)).astype(unit.dtype)
    d_top, d_mean = np.split(d_logit[:, None] * net["last"], 2, axis=1)
    is_top = (unit == top[owner]).astype(unit.dtype)
    shared = np.add.reduceat(is_top, start, axis=0)
    d_unit = ((d_mean / count)[owner] + is_top * (d_top / shared)[owner]) * (unit > 0)
    d_best = (d_unit @ net["hidden"].T) * (seen > 0)
    out = {"last": features.T @ d_logit, "last_bias": d_logit.sum(keepdims=True),
           "hidden": seen.T @ d_unit, "hidden_bias": d_unit.sum(axis=0), "filter_bias": d_best.sum(axis=0),
           "filters": np.zeros_like(net["filters"]), "bytes": np.zeros_like(net["bytes"])}
    at, each = np.arange(len(rows))[:, None], np.arange(best.shape[1])
    for k in range(WIDTH):  # only the place of the largest response learns
        cell = rows[at, where + k].astype(np.int64) * best.shape[1] + each
        d_table = np.bincount(cell.reshape(-1), d_best.reshape(-1), 256 * best.shape[1])
        d_table = d_table.reshape(256, -1).astype(unit.dtype)
        out["filters"][k] = net["bytes"].T @ d_table
        out["bytes"] += d_table @ net["filters"][k].T
    return float(loss), out


def trained(lessons: list[tuple[np.ndarray, int]], epochs: int = EPOCHS, seed: int = 0
            ) -> dict[str, np.ndarray]:
    """A network fitted by Adam to (chunks, label) pairs, in an order that ``seed`` decides; the step
    falls to zero towards the end."""
    net = fresh(seed)
    if not lessons:
        return net
    rng = np.random.default_rng(seed + 1)
    label = np.array([wanted for _, wanted in lessons])
    share = np.clip(label.mean(), 0.01, 0.99)
    net["last_bias"][:] = np.log(share / (1 - share))
    net["last"][:] = 0.2 * rng.standard_normal(2 * HIDDEN)
    first = {k: np.zeros_like(v) for k, v in net.items()}
    second = {k: np.zeros_like(v) for k, v in net.items()}
    step, steps = 0, epochs * -(-len(lessons) // BATCH)
    for _ in range(epochs):
        order = rng.permutation(len(lessons))
        for at in range(0, len(order), BATCH):
            some = order[at:at + BATCH]
            rows = np.concatenate([lessons[i][0] for i in some])
            owner = np.repeat(np.arange(len(some)), [len(lessons[i][0]) for i in some])
            _, grad = gradients(net, rows, owner, label[some])
            step += 1
            rate = RATE * (1 - (step - 1) / steps)
            for k, g in grad.items():
                first[k] += 0.1 * (g - first[k])
                second[k] += 0.001 * (g * g - second[k])
                net[k] -= (rate * first[k] / (1 - 0.9 ** step)
                           / (np.sqrt(second[k] / (1 - 0.999 ** step)) + 1e-8)).astype(net[k].dtype)
    return net


def scores(net: dict[str, np.ndarray], texts: list[str | None], table: np.ndarray | None = None,
           at_once: int = 4096) -> np.ndarray:
    """Probability of label 1 for each text. All chunks of a text count; at most about ``at_once``
    of them, of one text or several, are held at a time."""
    table = tables(net) if table is None else table
    top = np.zeros((len(texts), HIDDEN))
    total = np.zeros((len(texts), HIDDEN))
    count = np.zeros(len(texts), np.int64)
    waiting: list[tuple[int, np.ndarray]] = []

    def work() -> None:
        unit = hidden_units(net, responses(np.concatenate([r for _, r in waiting]), table)[0])
        start = np.cumsum([0] + [len(r) for _, r in waiting])
        for (text, _), a, b in zip(waiting, start[:-1], start[1:]):
            top[text] = np.maximum(top[text], unit[a:b].max(axis=0))
            total[text] += unit[a:b].sum(axis=0, dtype=np.float64)
            count[text] += b - a
        waiting.clear()

    held = 0
    for i, text in enumerate(texts):
        rows = chunks((text or "").encode())
        for at in range(0, len(rows), at_once):
            waiting.append((i, rows[at:at + at_once]))
            held += len(waiting[-1][1])
            if held >= at_once:
                work()
                held = 0
    if waiting:
        work()
    features = np.concatenate([top, total / np.maximum(count, 1)[:, None]], axis=1)
    return probability(features @ net["last"] + net["last_bias"])


def _sampled_chunks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in batches:
        found = []
        for text in frame["text"]:
            rows = chunks((text or "").encode())
            if len(rows) > SAMPLE_CHUNKS:
                rows = rows[np.linspace(0, len(rows) - 1, SAMPLE_CHUNKS).astype(int)]
            found.append(rows.tobytes())
        yield pd.DataFrame({"doc_id": frame["doc_id"], "quality": frame["quality"], "chunks": found})


def lessons(docs: DataFrame, labels: DataFrame) -> list[tuple[np.ndarray, int]]:
    """Chunks and label of at most ``SAMPLE_DOCS`` documents that are not held out and have a label.

    A doc_id is one lesson: where its rows or labels differ, the smallest text and label count.
    """
    known = labels.filter("doc_id IS NOT NULL AND quality IN (0, 1)").filter(~held_out(F.col("doc_id"))) \
        .groupBy("doc_id").agg(F.min("quality").cast("int").alias("quality"))
    n, place = known.count(), F.pmod(F.xxhash64("doc_id"), F.lit(1 << 40))
    # The bound on the hash leaves little for each task to sort; a few more than needed are asked for.
    share = min(1.0, 1.2 * SAMPLE_DOCS / max(n, 1) + 100 / max(n, 1))
    some = known.withColumn("place", place).filter(F.col("place") < int(share * (1 << 40))) \
        .orderBy("place", "doc_id").limit(SAMPLE_DOCS).select("doc_id", "quality")
    rows = docs.select("doc_id", "text").join(F.broadcast(some), "doc_id").groupBy("doc_id", "quality") \
        .agg(F.min(F.coalesce("text", F.lit(""))).alias("text")) \
        .mapInPandas(_sampled_chunks, "doc_id long, quality int, chunks binary").collect()
    return [(np.frombuffer(r["chunks"], np.uint8).reshape(-1, CHUNK), r["quality"])
            for r in sorted(rows, key=lambda r: r["doc_id"])]


def scored(docs: DataFrame, labels: DataFrame, net: dict[str, np.ndarray] | None = None,
           threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score and predicted for every row of ``docs`` (doc_id, text).

    ``score`` is the probability of quality 1, from the text alone; ``predicted`` is 1 from
    ``threshold`` on. Null texts count as empty, and empty ones have a score too. Rows that repeat
    are scored each. Without labels every score is one half. A null doc_id is neither held out nor
    learned from. An empty table gives no rows; other columns are not read.
    """
    learned = trained(lessons(docs, labels)) if net is None else net

    @F.pandas_udf("score double, predicted int")
    def judge(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        table = tables(learned)
        for texts in batches:
            found = scores(learned, list(texts), table)
            yield pd.DataFrame({"score": found, "predicted": (found >= threshold).astype(np.int32)})

    return (docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), judge("text").alias("found"))
            .select("doc_id", "held_out", "found.score", "found.predicted"))
