"""Base spans against plain patterns; what the trained model adds; masking."""

import hashlib
import itertools
import math
import random
import re
import time

import inputs
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerloom.llm import pii
from ledgerloom.llm.common import table

ORDER = ("email", "ip", "card", "phone")


def plain(text):
    found = [(m.start(), m.end(), "email")
             for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    found += [(m.start(), m.end(), "ip") for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text)
              if all(int(p) <= 255 for p in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[ -]", "", m[0])
        if 12 <= len(digits) <= 19 and pii.luhn(digits):
            found.append((m.start(), m.end(), "card"))
    found += [(m.start(), m.end(), "phone") for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text)
              if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15]
    return sorted(found, key=lambda s: (s[0], ORDER.index(s[2])))


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="ab1234567890.@+- ()_%é\n", max_size=60))
def test_base_spans(text):
    assert pii.base_spans(text) == plain(text)


def test_long_runs_take_no_time():
    for text in ("a" * 300_000, "1" * 300_000, "1." * 100_000, "a@" * 100_000, "+1" * 100_000, "é1 " * 20_000):
        pii.base_spans(text)


def test_found_in_given_documents(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    texts = {r.doc_id: r.text for r in docs.collect()}
    named = 0
    for r in pii.found(docs).collect():
        want = plain(texts[r.doc_id] or "")
        joined = ",".join(f"{k}:{s}:{e}" for s, e, k in want)
        assert r.base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == o for _, _, k in want) for o in ORDER]
        spans = r.spans.split(",") if r.spans else []
        assert set(joined.split(",") if joined else []) <= set(spans)
        for m in re.finditer(r"token = \"(\w+)\"", texts[r.doc_id] or ""):
            assert f"secret:{m.start(1)}:{m.end(1)}" in spans
            named += 1
    assert named


@pytest.fixture(scope="module")
def model(spark):
    return pii.trained(table(spark, "/root/testdata/sf0.01", "documents"))


def added(text, model):
    return [(text[s:e], k) for s, e, k in pii.all_spans(text, model)]


def test_clean_text_is_left_alone(model):
    for text in ("In 1998, 12 of 30 people met.", "version 2.0 of 3 parts", "a @ b", "It is 10:30 now.", "50% of 1,200",
                 "my password is long", 'token = "abc" 7', 'name = "correcthorsebattery" 7', "secret: 1"):
        assert added(text, model) == []


def test_named_values_are_found_and_their_surroundings_are_not(model):
    for text, value in (('key token = "9a8b7c6d5e4f3a2b1c9d" end', "9a8b7c6d5e4f3a2b1c9d"),
                        ('x password = "correcthorsebattery" y 1', "correcthorsebattery"),
                        ('token = "correcthorsebattery" since 2019', "correcthorsebattery"),
                        ("api_key: 'p@ss!wo$rd9' ok", "p@ss!wo$rd9")):
        assert added(text, model) == [(value, "secret")]
    seeds_only = pii.train([])
    assert added('say password="hushhushhush".', seeds_only) == [("hushhushhush", "secret")]


def chosen_at_random(seed):
    """Scored spans of a short island, and scores of transitions."""
    rng = random.Random(seed)
    n = rng.randrange(1, 6)
    ends = [[(first, [rng.gauss(0, 2) for _ in pii.KINDS]) for first in range(last + 1) if rng.random() < 0.4]
            for last in range(n)]
    return ends, [[rng.gauss(0, 1) for _ in range(6)] for _ in range(6)]


def segmentations(ends, moves):
    """Every way to cut the tokens, with its score: lists of (first, last, state)."""
    def go(at, state, path, score):
        if at == len(ends):
            yield path, score
            return
        yield from go(at + 1, 0, [*path, (at, at, 0)], score + moves[state][0])
        for last in range(at, len(ends)):
            for first, own in ends[last]:
                if first == at:
                    for k, s in enumerate(own, 1):
                        yield from go(last + 1, k, [*path, (at, last, k)], score + s + moves[state][k])
    return list(go(0, 0, [], 0.0))


@pytest.mark.parametrize("seed", range(40))
def test_sums_chances_and_decoding_against_all_segmentations(seed):
    ends, moves = chosen_at_random(seed)
    ways = segmentations(ends, moves)
    total, chances, often = pii.expected(ends, moves)
    assert total == pytest.approx(math.log(sum(math.exp(s) for _, s in ways)))
    for last, spans in enumerate(ends):
        for (first, _), found in zip(spans, chances[last]):
            for k in range(1, 6):
                want = sum(math.exp(s - total) for path, s in ways if (first, last, k) in path)
                assert found[k - 1] == pytest.approx(want)
    want = np.zeros((6, 6))
    for path, s in ways:
        for (_, _, y), (_, _, z) in itertools.pairwise([(0, 0, 0), *path]):
            want[y, z] += math.exp(s - total)
    assert np.allclose(often, want)
    best, _ = max(ways, key=lambda w: w[1])
    assert pii.decode(ends, moves) == [(f, e, pii.KINDS[k - 1]) for f, e, k in best if k]


def test_ties_are_decoded_alike():
    flat = [[0.0] * 6 for _ in range(6)]
    assert pii.decode([[(0, [0.0] * 5)]], flat) == []
    assert pii.decode([[(0, [1.0] * 5)], [(0, [1.0] * 5)]], flat) == [(0, 0, "email")]
    assert pii.decode([], flat) == []


def test_gradient_is_that_of_the_likelihood():
    taught = pii.lessons(['call +1 743 555 3824 or token = "abcdefgh12" now', "a.b@c.de 10.0.0.1 4929348385146306"])
    rng = random.Random(1)
    names = sorted({f for ends, _ in taught for spans in ends for _, has in spans for f in has})
    weights = {f: [rng.gauss(0, 0.3) for _ in pii.KINDS] for f in names}
    moves = [[rng.gauss(0, 0.3) for _ in range(6)] for _ in range(6)]
    value, by_feature, by_move = pii.likelihood(pii.Model(weights, moves), taught)
    assert value < 0 and sum(len(want) for _, want in taught) >= 4

    def shifted(change):
        w, m = {f: list(v) for f, v in weights.items()}, [list(v) for v in moves]
        change(w, m)
        return pii.likelihood(pii.Model(w, m), taught)[0]

    step = 1e-5
    for f in names[::3]:
        for k in range(5):
            up, down = (shifted(lambda w, m, d=d: w[f].__setitem__(k, w[f][k] + d)) for d in (step, -step))
            assert (up - down) / (2 * step) == pytest.approx(by_feature[f][k], abs=1e-4)
    for y, z in itertools.product(range(6), repeat=2):
        up, down = (shifted(lambda w, m, d=d: m[y].__setitem__(z, m[y][z] + d)) for d in (step, -step))
        assert (up - down) / (2 * step) == pytest.approx(by_move[y, z], abs=1e-4)


def test_training_raises_the_likelihood():
    texts = ["write to a.b@c.de in 1998", 'token = "abcdefgh12" 7', "call +1 743 555 3824 at 10:30"]
    flat = pii.Model({}, [[0.0] * 6 for _ in range(6)])
    assert pii.likelihood(pii.train(texts), pii.lessons(texts))[0] > pii.likelihood(flat, pii.lessons(texts))[0] / 4


def test_long_texts_full_of_triggers(model):
    begun = time.time()
    for text in ("1 " * 50_000, "a@b.cd " * 20_000, "1" * 100_000, 'token = "x1" ' * 10_000, "1." * 50_000, "@" * 50_000):
        assert set(pii.base_spans(text)) <= set(pii.all_spans(text, model))
    text = "1 2 x " * 20_000 + 'password = "correcthorsebattery"'
    assert (len(text) - 20, len(text) - 1, "secret") in pii.all_spans(text, model)
    assert time.time() - begun < 120


def test_learning_from_long_repeated_and_odd_texts(spark):
    long = "word " * 5_000 + 'passwd = "x7x7x7x7x7" ' + "word " * 5_000
    docs = inputs.documents(spark, [long] * 5 + inputs.odd_texts())
    assert added('passwd = "x7x7x7x7x7"', pii.trained(docs)) == [("x7x7x7x7x7", "secret")]
    assert pii.trained(docs.limit(0)).weights.keys() == pii.train([]).weights.keys()


def test_masking(spark):
    docs = inputs.documents(spark, ["write to a.b@c.de now", "call +1 (743) 555-3824 or 4929348385146306!", *inputs.odd_texts()])
    got = pii.masked(docs)
    assert got.columns == docs.columns
    rows = {r.doc_id: r.text for r in got.collect()}
    assert rows[0] == "write to [EMAIL] now" and "555" not in rows[1] and "49293" not in rows[1]
    assert [rows[i + 2] for i in range(len(inputs.odd_texts()))] == inputs.odd_texts()
    assert pii.replaced("abcdefgh", [(1, 4, "ip"), (2, 6, "card")]) == "a[IP]gh"
    assert pii.found(docs.limit(0)).count() == 0
