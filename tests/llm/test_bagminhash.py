"""Signatures against exact similarity, classes against brute force."""

import itertools
import re
from collections import Counter, defaultdict

import inputs
import numpy as np
import pytest

from ledgerloom.llm import bagminhash
from ledgerloom.llm.common import table


def words(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall("[a-z0-9\x80-\U0010ffff]+", lowered)


def bag(text):
    own = words(text)
    size = min(5, len(own))
    return Counter(tuple(own[i:i + size]) for i in range(len(own) - size + 1)) if own else Counter()


def similarity(a, b):
    common = sum(min(n, b[g]) for g, n in a.items() if g in b)
    total = sum(a.values()) + sum(b.values()) - common
    return common / total if total else 0.0


def brute_classes(rows):
    """class_id by doc_id, for distinct ids."""
    parent = {i: i for i, _ in rows}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    def join(a, b):
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)

    first, holders = {}, defaultdict(list)
    for i, text in rows:
        if text is not None:
            if text in first:
                join(i, first[text])
            else:
                first[text] = i
    bags = {i: bag(t) for t, i in first.items()}
    for i, own in bags.items():
        for gram in own:
            holders[gram].append(i)
    pairs = {p for ids in holders.values() for p in itertools.combinations(ids, 2)}
    for a, b in pairs:
        if similarity(bags[a], bags[b]) >= 0.8:
            join(a, b)
    return {i: find(i) for i, _ in rows}


@pytest.mark.parametrize("heaviest", [1, 3, 40, 5000])
def test_registers_agree_as_often_as_weights(heaviest):
    rng = np.random.default_rng(heaviest)
    errors = []
    for _ in range(40):
        items = np.sort(rng.integers(0, 2**63, 150, dtype=np.uint64))
        one = rng.integers(0, heaviest + 1, 150)
        two = np.where(rng.random(150) < 0.7, one, rng.integers(0, heaviest + 1, 150))
        bags = [(items[w > 0], w[w > 0]) for w in (one, two)]
        regs = bagminhash.signatures(bags, 144)
        errors.append((regs[0] == regs[1]).mean() - bagminhash.weighted_jaccard(*bags))
    assert abs(np.mean(errors)) < 0.025  # standard error below 0.006


def test_a_signature_does_not_depend_on_its_batch():
    bags = bagminhash.bags([inputs.prose(n, n) for n in (5, 40, 700)])
    together = bagminhash.signatures(bags, 48)
    for one, regs in zip(bags, together):
        assert (bagminhash.signatures([one], 48)[0] == regs).all()


def test_bags_count_shingles():
    texts = [*inputs.odd_texts(), "A b. C d e! a B c d e"]
    for text, (keys, counts) in zip(texts, bagminhash.bags(texts)):
        assert sorted(counts.tolist()) == sorted(bag(text).values())
        assert len(set(keys.tolist())) == len(keys)


def test_classes_of_given_documents_match_brute_force(spark):
    docs = table(spark, inputs.SF_DIR, "documents")
    got = {r.doc_id: r.class_id for r in bagminhash.near_duplicate_classes(docs).collect()}
    assert got == brute_classes([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])


def edited_copies():
    """A chain in which only neighbours are near, and a crowd around one text."""
    rows, base = [], inputs.prose(300, 5, 10_000).split()
    for step in range(8):
        rows.append((100 + step, " ".join(base[12 * step:12 * step + 200])))
    crowd = inputs.prose(260, 6, 10_000).split()
    for n in range(60):
        own = list(crowd)
        own[n * 4] = f"new{n}"
        rows.append((200 + n, " ".join(own)))
    return rows


def test_chains_and_crowds(spark):
    rows = edited_copies()
    docs = inputs.documents(spark, [t for _, t in rows], [i for i, _ in rows])
    got = {r.doc_id: r.class_id for r in bagminhash.near_duplicate_classes(docs).collect()}
    assert got == brute_classes(rows)
    assert sorted(r.doc_id for r in bagminhash.keep_one_each(docs).collect()) == sorted(set(got.values()))


def test_odd_rows(spark):
    texts = inputs.odd_texts()
    docs = inputs.documents(spark, texts)
    got = {r.doc_id: r.class_id for r in bagminhash.near_duplicate_classes(docs).collect()}
    assert got == brute_classes(list(enumerate(texts)))
    kept = bagminhash.keep_one_each(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(got.values()))


def test_repeated_and_missing_ids(spark):
    one, two = inputs.prose(80, 1), inputs.prose(80, 2)
    docs = inputs.documents(spark, [one, one, two, one, None, None], [7, 7, 7, None, None, None])
    assert bagminhash.near_duplicate_classes(docs).count() == 6
    kept = [(r.doc_id, r.text) for r in bagminhash.keep_one_each(docs).collect()]
    assert sorted(kept, key=str) == sorted([(7, one), (7, two), (None, None), (None, None)], key=str)


def test_empty_table(spark):
    docs = inputs.documents(spark, ["x"]).limit(0)
    assert bagminhash.near_duplicate_classes(docs).count() == 0
    assert bagminhash.keep_one_each(docs).count() == 0


def test_parities_bound_the_difference():
    rng = np.random.default_rng(8)
    for size in (0, 1, 5, 90, 400):
        one = rng.integers(0, 2**64, size, np.uint64)
        two = np.unique(np.concatenate([one[:size // 2], rng.integers(0, 2**64, 60, np.uint64)]))
        apart = len(np.setxor1d(one, two))
        bits = sum(int(x).bit_count() for x in (bagminhash.parities(one) ^ bagminhash.parities(two)).view(np.uint64))
        assert len(bagminhash.parities(one)) == bagminhash.PARITY_WORDS and bits <= apart and (bits - apart) % 2 == 0
