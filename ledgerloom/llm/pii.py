"""Personal data by a semi-Markov conditional random field over whole spans.

Patterns give base spans of four kinds. Around every trigger (a digit, an at sign, or a quoted value
given to a name such as ``password = "..."``) a semi-Markov model then looks for further spans. A
segmentation cuts the tokens there into segments: single tokens outside, and candidate spans of at
most ``MAX_TOKENS`` tokens, each of one kind. Its score is the sum of features of whole spans (shape,
digit groups, checksums, what stands before) and of transitions between the kinds of neighbouring
segments; its probability is the exponential of that over the sum for all segmentations. Dynamic
programming gives this sum, the probabilities of spans and the best segmentation, which chooses
boundaries and kinds jointly. Base spans stay; model spans are taken where they touch none of them.

The model is trained here, by ascent of the regularised log-likelihood, on a bounded sample of
stretches of the documents: base spans and values given to names are its labels, all other candidates
count against. Each named value is also shown without its digits, and ``SEEDS`` is always shown.
"""

from __future__ import annotations

import hashlib
import math
import re
import string
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = ("email", "ip", "card", "phone", "secret")
BASE_KINDS = KINDS[:4]
MAX_TOKENS = 16
REACH = 16  # tokens looked at on both sides of a trigger
#: Bounds of the training sample: stretches of texts, of so many characters, and ranges around triggers
#: in them; those with the smallest hashes, wherever they stand.
TRAIN_STRETCHES = 400
STRETCH = 4_000
TRAIN_ISLANDS = 600
STEPS = 60
RATE = 0.3
PENALTY = 0.02  # of squared weights, for the whole sample

_LOCAL = frozenset(string.ascii_letters + string.digits + "._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_CHAIN = re.compile(r"[0-9]++(?:\.[0-9]++)*+")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_NAME = r"\b(?:token|secret|api_key|apikey|password|passwd)\s*[=:]\s*"
_NAMED = re.compile(_NAME + r"""(["'])((?:(?!\1)\S){8,})\1""", re.I)
_VALUE = re.compile(_NAME + r"""(["'])(?=[^\s"'])""", re.I)
_TRIGGER = re.compile(r"[0-9@]")
#: Lessons that every model sees: values with and without digits, and numbers that are nobody's.
SEEDS = tuple(
    [f'{name} = "{value}" {rest}' for name in ("token", "password", "api_key")
     for value in ("bluelanternriver", "k3y9d2m4x8q1z7", "Sun-set_walk", "w@lk!home$7") for rest in ("since 2019", "y 1", "at 10:30")]
    + ["since 2019 we", "x y 1 z", "part 3 of 12", "in 1998, 45 people", 'name = "somebodyelse" 7', 'token = "abc" 5'])
_TOKEN = re.compile(r"[^\W_]+|[^\s]")


def luhn(digits: str) -> bool:
    """The card checksum."""
    total = 0
    for i, d in enumerate(reversed(digits)):
        v = int(d) * (1 + i % 2)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            end = domain.end()
            yield start, end
        at = text.find("@", max(at + 1, end))


def _ips(text: str) -> Iterator[tuple[int, int]]:
    for chain in _CHAIN.finditer(text):
        parts = chain[0].split(".")
        at = chain.start()
        for i in range(0, len(parts) - 3, 4):
            four = parts[i:i + 4]
            size = sum(map(len, four)) + 3
            if all(len(p.lstrip("0")) < 4 and int(p.lstrip("0") or 0) <= 255 for p in four):
                yield at, at + size
            at += size + 1


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """Spans of the four patterns, (start, end, kind), by start and then kind."""
    if not _TRIGGER.search(text):
        return []
    found = [(s, e, "email") for s, e in _emails(text)]
    found += [(s, e, "ip") for s, e in _ips(text)]
    for m in _CARD.finditer(text):
        digits = re.sub("[ -]", "", m[0])
        if 12 <= len(digits) <= 19 and luhn(digits):
            found.append((m.start(), m.end(), "card"))
    for m in _PHONE.finditer(text):
        if 9 <= sum(map(str.isdigit, m[0])) <= 15:
            found.append((m.start(), m.end(), "phone"))
    return sorted(found, key=lambda s: (s[0], KINDS.index(s[2])))


def _bucket(n: int) -> int:
    return n if n < 5 else 5 if n < 8 else 8 if n < 12 else 12 if n < 20 else 20 if n < 32 else 32


def span_features(text: str, start: int, end: int, named: bool) -> tuple[str, ...]:
    """Names of the features of a whole span; ``named``: it starts a quoted value given to a name."""
    span = text[start:end]
    groups = re.findall(r"[0-9]+", span)
    digits = "".join(groups)
    shape = re.sub(r"[^\W\d_]+", "a", re.sub(r"[0-9]+", "9", span))
    plain = span.isalnum() and span.isascii()
    quote = text[start - 1] if start else ""
    whole = quote in ("'", '"') and text[end:end + 1] == quote
    has = ["", f"digits {_bucket(len(digits))}", f"groups {_bucket(len(groups))}", f"length {_bucket(len(span))}"]
    if len(shape) <= 16:
        has.append(f"shape {shape}")
    if whole:
        has.append("quoted")
    if named:
        has.append(f"named {whole} {len(span) >= 8}")
    if "@" in span:
        has.append(f"at {span.count('@')} {bool(_DOMAIN.fullmatch(span.rpartition('@')[2]))} {' ' in span}")
    if len(groups) == 4 and shape == "9.9.9.9":
        has.append(f"octets {all(len(g) < 4 and int(g) < 256 for g in groups)}")
    if 12 <= len(digits) <= 19 and not re.search(r"[^0-9 -]", span):
        has.append(f"luhn {luhn(digits)}")
    if span[0] == "+":
        has.append("plus")
    if plain and len(span) >= 16 and digits and len(digits) < len(span):
        has.append("mixed code")
    return tuple(has)


Spans = list[list[tuple[int, tuple]]]  # for each token the spans that end with it: (first token, ...)


def _values(text: str, tokens: list[re.Match]) -> set[int]:
    """Tokens that begin a quoted value given to a name."""
    starts = [t.start() for t in tokens]
    return {bisect_left(starts, m.end()) for m in _VALUE.finditer(text)}


def _islands(tokens: list[re.Match], values: set[int]) -> list[tuple[int, int]]:
    """Ranges of tokens within reach of a trigger."""
    ranges: list[list[int]] = []
    for i, t in enumerate(tokens):
        if i in values or _TRIGGER.search(t[0]):
            low, high = max(0, i - REACH), min(len(tokens), i + REACH + 1)
            if ranges and low <= ranges[-1][1]:
                ranges[-1][1] = high
            else:
                ranges.append([low, high])
    return [(a, b) for a, b in ranges]


def _segments(text: str, tokens: list[re.Match], low: int, high: int, values: set[int]) -> Spans:
    """For each token of an island the candidate spans that end with it: (first token, features).

    A span holds a digit or an at sign, has no wide gaps, and is cut off neither inside a run of
    characters that belong together; or it is all of a quoted value given to a name.
    """
    ends: Spans = [[] for _ in range(high - low)]
    trigger = [bool(_TRIGGER.search(t[0])) for t in tokens[low:high]]
    for first in range(low, high):
        named, value = first in values, None
        if named:
            quote = text[tokens[first].start() - 1]
            last = first
            while last + 1 < high and last - first < MAX_TOKENS and tokens[last][0] != quote and (
                    tokens[last + 1].start() == tokens[last].end()):
                last += 1
            if tokens[last][0] == quote and last > first:
                value = last - 1
                ends[value - low].append((first - low, span_features(
                    text, tokens[first].start(), tokens[value].end(), True)))
        if tokens[first][0] in ".,;:!?=)\"'":
            continue
        if first > low and tokens[first - 1].end() == tokens[first].start() and tokens[first - 1][0].isalnum():
            continue
        seen = False
        for last in range(first, min(high, first + MAX_TOKENS)):
            if last > first and tokens[last].start() - tokens[last - 1].end() > 1:
                break
            if last > first and tokens[last][0] in "\"'=,;!?*#$&<>|":
                break
            if last > first and tokens[last].start() > tokens[last - 1].end() and not (
                    trigger[last - low] or tokens[last][0] in "(+"):
                break  # words after a gap are no part of a span
            seen = seen or trigger[last - low]
            joined = last + 1 < len(tokens) and tokens[last + 1].start() == tokens[last].end() and (
                tokens[last + 1][0].isalnum())
            if seen and not joined and tokens[last][0] not in ".,;:(+" and last != value:
                ends[last - low].append((first - low, span_features(
                    text, tokens[first].start(), tokens[last].end(), named)))
    return ends


@dataclass(frozen=True)
class Model:
    """Scores of each feature for the kinds in turn, and of a segment of one state after another;
    state 0 is outside, before all tokens too, and the others are the kinds."""
    weights: dict[str, list[float]]
    moves: list[list[float]]

    def scored(self, ends: Spans) -> Spans:
        """The spans with their scores for the kinds in place of their features."""
        none = [0.0] * len(KINDS)
        return [[(first, [sum(column) for column in zip(*(self.weights.get(f, none) for f in has))])
                 for first, has in spans] for spans in ends]


def _log_sum(terms: list[float]) -> float:
    if len(terms) == 1:
        return terms[0]
    top = max(terms)
    return top + math.log(sum(math.exp(t - top) for t in terms))


def expected(ends: Spans, moves: list[list[float]]) -> tuple[float, list[list[list[float]]], np.ndarray]:
    """Of scored spans: the log of the sum over all segmentations, the probabilities of each span for
    the kinds, and how often each state is expected after each other. Forward and backward pass."""
    kinds = range(1, len(KINDS) + 1)
    before: list[list[tuple[int, float]]] = [[(0, 0.0)]]  # states of the last segment and their log sums

    def arrivals(first: int) -> list[float]:
        return [_log_sum([v + moves[y][k] for y, v in before[first]]) for k in kinds]

    into = []
    for last, spans in enumerate(ends):
        here = [(0, _log_sum([v + moves[y][0] for y, v in before[last]]))]
        into.append([arrivals(first) for first, _ in spans])
        if spans:
            here += [(k, _log_sum([came[k - 1] + own[k - 1] for came, (_, own) in zip(into[last], spans)]))
                     for k in kinds]
        before.append(here)
    total = _log_sum([v for _, v in before[-1]])

    starts: list[list[tuple[int, list[float]]]] = [[] for _ in ends]
    for last, spans in enumerate(ends):
        for first, own in spans:
            starts[first].append((last, own))
    after: list[dict[int, float]] = [{} for _ in ends] + [{y: 0.0 for y, _ in before[-1]}]
    often = np.zeros((len(KINDS) + 1, len(KINDS) + 1))
    for at in range(len(ends) - 1, -1, -1):
        leave = [(0, after[at + 1][0])]
        if starts[at]:
            leave += [(k, _log_sum([own[k - 1] + after[last + 1][k] for last, own in starts[at]])) for k in kinds]
        for y, v in before[at]:
            after[at][y] = _log_sum([moves[y][z] + w for z, w in leave])
            for z, w in leave:
                often[y, z] += math.exp(v + moves[y][z] + w - total)
    chances = [[[math.exp(came[k - 1] + own[k - 1] + after[last + 1][k] - total) for k in kinds]
                for came, (_, own) in zip(into[last], spans)] for last, spans in enumerate(ends)]
    return total, chances, often


def decode(ends: Spans, moves: list[list[float]]) -> list[tuple[int, int, str]]:
    """The best segmentation of scored spans: (first token, last token, kind) of each span in it. Of
    equal ones that with the state outside, then the earlier kind, then the earlier beginning."""
    best: list[dict[int, tuple[float, int, int]]] = [{0: (0.0, 0, 0)}]  # state: score, first token, state before
    for last, spans in enumerate(ends):
        here = {0: max((v + moves[y][0], -last, -y) for y, (v, _, _) in best[last].items())}
        for first, own in spans:
            for k, s in enumerate(own, 1):
                way = max((v + moves[y][k] + s, -first, -y) for y, (v, _, _) in best[first].items())
                if k not in here or way > here[k]:
                    here[k] = way
        best.append({y: (v, -f, -z) for y, (v, f, z) in here.items()})
    found, at = [], len(ends)
    state = max(best[at], key=lambda y: (best[at][y][0], -y))
    while at:
        _, first, previous = best[at][state]
        if state:
            found.append((first, at - 1, KINDS[state - 1]))
        at, state = first, previous
    return found[::-1]


def _labels(text: str) -> list[tuple[int, int, str]]:
    """Spans to be learned, none of which overlap: the earlier and then the longer one counts."""
    named = [(m.start(2), m.end(2), "secret") for m in _NAMED.finditer(text)]
    labels, reach = [], 0
    for start, end, kind in sorted(base_spans(text) + named, key=lambda s: (s[0], -s[1])):
        if start >= reach:
            labels.append((start, end, kind))
            reach = end
    return labels


def lessons(texts: list[str]) -> list[tuple[Spans, set[tuple[int, int, str]]]]:
    """Candidate spans of islands, and those of them that are right."""
    found = []
    for text in texts:
        tokens = list(_TOKEN.finditer(text))
        values, gold = _values(text, tokens), _labels(text)
        for low, high in _islands(tokens, values):
            index = {t.start(): i for i, t in enumerate(tokens[low:high])}
            upto = {t.end(): i for i, t in enumerate(tokens[low:high])}
            ends = _segments(text, tokens, low, high, values)
            want = {(index[s], upto[e], k) for s, e, k in gold
                    if s in index and e in upto and any(f == index[s] for f, _ in ends[upto[e]])}
            stretch = text[tokens[low].start():tokens[high - 1].end()]
            found.append((hashlib.blake2b(stretch.encode("utf-8", "surrogatepass"), digest_size=8).digest(), ends, want))
    return [(ends, want) for _, ends, want in sorted(found, key=lambda x: x[0])]


def likelihood(model: Model, taught: list[tuple[Spans, set]]) -> tuple[float, dict[str, np.ndarray], np.ndarray]:
    """Log-likelihood of the right segmentations, and its gradient by features and by transitions."""
    value, by_feature, by_move = 0.0, {}, np.zeros((len(KINDS) + 1, len(KINDS) + 1))
    for ends, want in taught:
        scored = model.scored(ends)
        total, chances, often = expected(scored, model.moves)
        value -= total
        by_move -= often
        right = {(first, last): KINDS.index(kind) for first, last, kind in want}
        for last, spans in enumerate(ends):
            for (first, has), (_, own), chance in zip(spans, scored[last], chances[last]):
                kind = right.get((first, last))
                slope = -np.array(chance)
                if kind is not None:
                    value += own[kind]
                    slope[kind] += 1.0
                for f in has:
                    if f in by_feature:
                        by_feature[f] += slope
                    else:
                        by_feature[f] = slope.copy()
        at, state = 0, 0
        inside = {first: (last, KINDS.index(kind) + 1) for first, last, kind in want}
        while at < len(ends):
            last, now = inside.get(at, (at, 0))
            value += model.moves[state][now]
            by_move[state, now] += 1.0
            at, state = last + 1, now
    return value, by_feature, by_move


def train(texts: list[str]) -> Model:
    """The model of greatest penalised likelihood, by adaptive ascent (Adam) over the whole sample."""
    bare = [re.sub("[0-9]", "x", m[0]) + " 1" for t in texts for m in _NAMED.finditer(t)]
    taught = lessons(texts)[:TRAIN_ISLANDS] + lessons(bare)[:TRAIN_ISLANDS // 4] + lessons(list(SEEDS))
    names = sorted({f for ends, _ in taught for spans in ends for _, has in spans for f in has})
    n, states = len(names), len(KINDS) + 1
    x = np.zeros(n * len(KINDS) + states * states)
    drift, spread = np.zeros_like(x), np.zeros_like(x)

    def model() -> Model:
        rows = x[:n * len(KINDS)].reshape(n, -1).tolist()
        return Model(dict(zip(names, rows)), x[n * len(KINDS):].reshape(states, states).tolist())

    for step in range(1, STEPS + 1):
        _, by_feature, by_move = likelihood(model(), taught)
        slope = np.concatenate([*(by_feature[f] for f in names), by_move.ravel()]) - 2 * PENALTY * x
        drift = 0.9 * drift + 0.1 * slope
        spread = 0.99 * spread + 0.01 * slope * slope
        x = x + RATE * (drift / (1 - 0.9 ** step)) / (np.sqrt(spread / (1 - 0.99 ** step)) + 1e-8)
    return model()


def all_spans(text: str, model: Model) -> list[tuple[int, int, str]]:
    """Base spans, and model spans that touch none of them, by start and then kind."""
    if not _TRIGGER.search(text) and not _VALUE.search(text):
        return []
    base = base_spans(text)
    tokens = list(_TOKEN.finditer(text))
    values = _values(text, tokens)
    added = []
    for low, high in _islands(tokens, values):
        ends = model.scored(_segments(text, tokens, low, high, values))
        for first, last, kind in decode(ends, model.moves):
            added.append((tokens[low + first].start(), tokens[low + last].end(), kind))
    taken = sorted(base)
    fresh, i, reach = [], 0, 0
    for start, end, kind in sorted(added):
        while i < len(taken) and taken[i][0] < end:
            reach = max(reach, taken[i][1])
            i += 1
        if reach <= start:
            fresh.append((start, end, kind))
    return sorted(base + fresh, key=lambda s: (s[0], KINDS.index(s[2])))


def trained(docs: DataFrame) -> Model:
    """A model of the bounded sample: of all stretches with a trigger, those with the smallest hash.

    Texts of any length take part by their stretches. The number of different ones is estimated
    first, so that no more than about twice the sample leaves the tasks.
    """
    places = F.sequence(F.lit(0), F.floor((F.length("text") - 1) / STRETCH))
    whole = (docs.filter(F.col("text").rlike(f"[0-9@]|(?i:{_NAME})"))
             .select(F.explode(F.transform(places, lambda i: F.substr("text", (i * STRETCH + 1).cast("int"), F.lit(STRETCH))))
                     .alias("stretch")).withColumn("place", F.pmod(F.xxhash64("stretch"), F.lit(1 << 40))))
    many = whole.agg(F.approx_count_distinct("place").alias("n")).first()["n"]
    share = min(1.0, 2 * TRAIN_STRETCHES / max(many, 1))
    rows = (whole.filter(F.col("place") < int(share * (1 << 40))).distinct().orderBy("place", "stretch")
            .limit(TRAIN_STRETCHES).collect())
    return train([r["stretch"] for r in rows])


def _joined(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{k}:{s}:{e}" for s, e, k in spans)


SCHEMA = ", ".join([*(f"n_{k} long" for k in BASE_KINDS), "base_sha256 string", "spans string",
                    "masked string"])


def _finder(model: Model, mask: bool):
    names = [c.split()[0] for c in SCHEMA.split(", ")]

    @F.pandas_udf(SCHEMA)
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            rows = []
            for text in texts:
                spans = all_spans(text or "", model)
                base = base_spans(text or "")
                count = Counter(k for _, _, k in base)
                rows.append((*(count[k] for k in BASE_KINDS),
                             hashlib.sha256(_joined(base).encode()).hexdigest(), _joined(spans),
                             replaced(text, spans) if mask else None))
            yield pd.DataFrame(rows, columns=names)
    return run.asNondeterministic()


def replaced(text: str | None, spans: list[tuple[int, int, str]]) -> str | None:
    """The text with every span replaced by its kind in brackets; overlapping spans count as one,
    named for the first."""
    if not spans:
        return text
    out, at, reach = [], 0, -1
    for start, end, kind in spans:
        if start >= reach:
            out += [text[at:start], f"[{kind.upper()}]"]
        reach = max(reach, end)
        at = max(at, end)
    return "".join([*out, text[at:]])


def found(docs: DataFrame) -> DataFrame:
    """doc_id, counts of base spans by kind, the digest of base spans, and all spans.

    Null and empty texts have no spans. One row per row of ``docs``, repeated ones too; an empty
    table gives no rows; other columns are not read.
    """
    run = _finder(trained(docs), mask=False)
    return (docs.select("doc_id", run("text").alias("found"))
            .select("doc_id", *(f"found.n_{k}" for k in BASE_KINDS), "found.base_sha256", "found.spans"))


def masked(docs: DataFrame) -> DataFrame:
    """``docs`` with all columns; in ``text`` every span is replaced by its kind, and ``n_chars``, if
    there is one, follows. Null texts stay null."""
    run = _finder(trained(docs), mask=True)
    new = docs.withColumn("__found", run("text")).withColumn("text", F.col("__found.masked"))
    if "n_chars" in docs.columns:
        new = new.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(
            F.length("text")).cast(docs.schema["n_chars"].dataType))
    return new.select(docs.columns)
