"""Ids against the tokenizer, pieces against a round trip, cuts against all segmentations."""

import itertools
import random
import zlib
from collections import defaultdict

import inputs
import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from ledgerloom.llm import packing
from ledgerloom.llm.common import table


@pytest.fixture(scope="module")
def exact():
    tool = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    return lambda text: tool.encode(text or "", add_special_tokens=False).ids


def test_ids(exact):
    encoder = packing.Encoder(*(public_tokenizers.path(n) for n in (packing.VOCABULARY, packing.LIBRARY_VOCABULARY)))
    texts = [*[t for t in inputs.odd_texts() if len(t or "") < 9999], "a  b", "a \n b", "\n", " lead", "trail ", "a\tb c",
             "it's 'ok' don't", "<|endoftext|> a b", "日本 語", "a\r\n\r\nb c  ", "x\n\ny\n\n", "a\x85b  c", "a\x00b c"]
    for text in texts:
        assert np.frombuffer(encoder.ids(text or ""), "<u4").tolist() == exact(text)


def holds(spark, docs, exact):
    """Every id in one piece; sequences without gaps, no longer than the window, in order."""
    ids = defaultdict(list)
    for r in docs.collect():
        ids[r.doc_id].append([*exact(r.text), 0])
    pieces = packing.packed(docs).collect()
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for p in pieces:
        by_doc[p.doc_id].append(p)
        by_sequence[p.sequence_id].append(p)
    assert set(by_doc) == set(ids)
    for doc_id, own in by_doc.items():
        if len(ids[doc_id]) > 1:
            continue  # repeated ids are counted below
        at, tokens = 0, ids[doc_id][0]
        for p in sorted(own, key=lambda p: p.start):
            part = np.array(tokens[p.start:p.start + p.length], "<u4").tobytes()
            assert p.start == at and p.doc_tokens == len(tokens) and p.ids_crc32 == zlib.crc32(part)
            at += p.length
        assert at == len(tokens)
    assert sum(p.length for p in pieces) == sum(len(t) for own in ids.values() for t in own)
    padding = total = 0
    for own in by_sequence.values():
        at = 0
        for p in sorted(own, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= 1024
        padding += 0 if at & (at - 1) == 0 else 1024 - at
        total += at
    return padding / (padding + total) if total else 0.0


def test_given_documents(spark, exact):
    assert holds(spark, table(spark, "/root/testdata/sf0.01", "documents"), exact) < 0.02


def test_odd_rows(spark, exact):
    texts = [t for t in inputs.odd_texts() if len(t or "") < 60_001]
    holds(spark, inputs.documents(spark, texts), exact)
    holds(spark, inputs.documents(spark, ["a b", "a b", "c", None], [1, 1, None, None]), exact)
    assert packing.packed(inputs.documents(spark, ["x"]).limit(0)).count() == 0


def test_cuts_are_the_cheapest():
    rng = random.Random(1)
    for _ in range(150):
        where = sorted({0, *(rng.randrange(1, 60) for _ in range(9))})
        cost = [0] + [rng.choice([0, 4, 24]) for _ in where[1:]]

        def price(cuts):
            total, before = 0, 0
            for c in cuts:
                size = c - before
                if size > 32:
                    return float("inf")
                total += (0 if size & (size - 1) == 0 else 32 - size) + cost[where.index(c)] + packing.SEQUENCE_COST
                before = c
            return total

        ways = [(*way, where[-1]) for n in range(len(where) - 1)
                for way in itertools.combinations(where[1:-1], n)]
        cheapest = min(map(price, ways))
        if cheapest < float("inf") and all(b - a <= 32 for a, b in zip(where, where[1:])):
            assert price(packing.best_cuts(where, cost, True, 32)) == cheapest
