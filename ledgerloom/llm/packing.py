"""Order-preserving packing of tokenised documents into training sequences.

Documents, in order of doc_id, form one stream of tokens per partition; windows of the stream are
the sequences. Dynamic programming chooses the cuts: a window costs its padding (none at a length
that is a power of two) and a little for each sequence; a cut costs nothing at the end of a document,
something at the end of a sentence, and more within a long sentence. The best predecessor of a cut is
the smallest of a sliding window of earlier cuts, which a monotone queue yields in constant time.
"""

from __future__ import annotations

import zlib
from array import array
from bisect import bisect_left
from collections import deque
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WINDOW = 1024
SEQUENCE_COST = 16
SENTENCE_COST, INNER_COST = 4, 24
INNER_STEP = 64  # within a sentence, a cut is offered after so many tokens
BUFFER = 200_000  # tokens the cuts of which are chosen together
VOCABULARY, LIBRARY_VOCABULARY = "byte_bpe_50k.json", "byte_bpe_50k.tiktoken"

SCHEMA = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, "
          "offset long")


class Encoder:
    """Ids of a text as little-endian unsigned 32-bit bytes.

    The ids are those of the tokenizer file ``json_file``; ``rank_file`` is the same vocabulary in a
    form that is faster to use, by a library that knows no special tokens, so texts that hold one
    are left to the tokenizer file.
    """

    def __init__(self, json_file: str, rank_file: str):
        import base64

        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer

        with open(rank_file, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self._encode = tiktoken.Encoding(
            "ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
            special_tokens={}).encode_ordinary
        self._exact = Tokenizer.from_file(json_file)
        self._special = [t.content for t in self._exact.get_added_tokens_decoder().values()]
        size = self._exact.get_vocab_size()
        self.ends_sentence = np.zeros(size, bool)
        for token, number in ranks.items():
            self.ends_sentence[number] = token.rstrip()[-1:] in (b".", b"!", b"?") or b"\n" in token

    def ids(self, text: str) -> bytes:
        if any(s in text for s in self._special):
            return array("I", self._exact.encode(text, add_special_tokens=False).ids).tobytes()
        return array("I", self._encode(text)).tobytes()


def cut_points(doc_ids: list[bytes], ends_sentence: np.ndarray, skip: int) -> tuple[list, list]:
    """Positions in the stream where it may be cut, with the cost of each. The stream starts
    ``skip`` tokens into the first document."""
    stream = np.frombuffer(b"".join(doc_ids), "<u4")[skip:]
    doc_ends = np.cumsum([len(ids) // 4 for ids in doc_ids]) - skip
    ends = np.union1d(np.flatnonzero(ends_sentence[stream]) + 1, doc_ends)
    marks = np.concatenate([[0], ends])
    inner = (np.diff(marks) - 1) // INNER_STEP  # cuts offered within each sentence
    order = np.arange(int(inner.sum())) - np.repeat(np.cumsum(inner) - inner, inner)
    inside = np.repeat(marks[:-1], inner) + (order + 1) * INNER_STEP
    costs = np.where(np.isin(ends, doc_ends), 0, SENTENCE_COST)
    where = np.concatenate([[0], ends, inside])
    cost = np.concatenate([[0], costs, np.full(len(inside), INNER_COST)])
    place = np.argsort(where, kind="stable")
    return where[place].tolist(), cost[place].tolist()


def best_cuts(where: list[int], cost: list[int], last: bool, window: int = WINDOW) -> list[int]:
    """The chosen cuts, without position 0. Unless ``last``, the stream goes on: the last cut is then
    the cheapest one within a window's length of the end."""
    index = dict(zip(where, range(len(where))))
    powers = [1 << k for k in range(window.bit_length()) if 1 << k < window]
    total, back = [0.0], [0]
    queue = deque([0])
    for j in range(1, len(where)):
        here = where[j]
        while here - where[queue[0]] > window:
            queue.popleft()
        before = queue[0]
        least = total[before] + window - (here - where[before])
        for i in [index[here - p] for p in powers if here - p in index]:  # no padding
            if total[i] < least:
                before, least = i, total[i]
        total.append(least + cost[j] + SEQUENCE_COST)
        back.append(before)
        while queue and total[queue[-1]] + where[queue[-1]] >= total[j] + here:
            queue.pop()
        queue.append(j)
    at = len(where) - 1
    if not last:
        near = range(bisect_left(where, where[-1] - window), len(where))
        at = min(near, key=lambda i: total[i] + (where[-1] - where[i]) * (SEQUENCE_COST / window))
    cuts = []
    while at:
        cuts.append(where[at])
        at = back[at]
    return cuts[::-1]


def _pack(json_file: str, rank_file: str):
    names = [c.split()[0] for c in SCHEMA.split(", ")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = Encoder(json_file, rank_file)
        number = TaskContext.get().partitionId() << 40
        docs: list[tuple[object, bytes]] = []
        skip = held = 0

        def emit(last: bool) -> pd.DataFrame:
            nonlocal docs, skip, held, number
            cuts = best_cuts(*cut_points([d[1] for d in docs], encoder.ends_sentence, skip), last)
            rows, at, doc, start = [], 0, 0, skip
            for cut in cuts:
                offset = 0
                while at < cut:
                    doc_id, ids = docs[doc]
                    n = len(ids) // 4
                    size = min(n - start, cut - at)
                    rows.append((doc_id, start, size, zlib.crc32(ids[4 * start:4 * (start + size)]),
                                 n, number, offset))
                    at, start, offset = at + size, start + size, offset + size
                    if start == n:
                        doc, start = doc + 1, 0
                number += 1
            docs, skip, held = docs[doc:], start, held - at
            frame = pd.DataFrame(rows, columns=names)
            return frame.astype({"doc_id": "Int64"})

        for frame in batches:
            missing = frame["doc_id"].isna()
            for doc_id, no_id, text in zip(frame["doc_id"], missing, frame["text"]):
                ids = encoder.ids(text or "") + b"\0\0\0\0"
                docs.append((None if no_id else int(doc_id), ids))
                held += len(ids) // 4
                if held >= BUFFER:
                    yield emit(False)
        if docs:
            yield emit(True)
    return run


def packed(docs: DataFrame, json_file: str | None = None, rank_file: str | None = None) -> DataFrame:
    """Pieces of all documents, (doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset).

    Every document ends with id 0, so null and empty texts are one token. Documents follow each
    other by doc_id, then text; rows that repeat are packed each. Sequences are not joined across
    partitions, so at most one per partition is short for that reason. An empty table gives no rows;
    other columns are not read.
    """
    import public_tokenizers

    run = _pack(json_file or public_tokenizers.path(VOCABULARY),
                rank_file or public_tokenizers.path(LIBRARY_VOCABULARY))
    order = F.xxhash64("text").alias("__order")
    placed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", order)
    return (placed.repartitionByRange("doc_id", "__order").sortWithinPartitions("doc_id", "__order")
            .select("doc_id", "text").mapInPandas(run, SCHEMA))
