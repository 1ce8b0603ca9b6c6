"""Near-duplicate classes by BagMinHash over multisets of five-word shingles.

A shingle that occurs w times in a text has weight w. Its weight axis is discretised into unit
steps; each step carries an independent Poisson process of rate 1 whose points fall on random
registers, and a register keeps the earliest point it sees. Two texts then agree in a register
with probability equal to their weighted Jaccard similarity. Heavy weights need no walk over all
their steps: the axis is cut into octaves (0,1], (1,2], (2,4], (4,8], ... and the process of an
octave is followed as one process of higher rate that is halved, point by point, until a unit step
is reached. Whatever lies after the largest register so far is dropped with all below it.

Signatures are cut into bands; texts that share a band are candidates; candidates are verified by
exact multiset overlap. No group is expanded into all pairs: members of a bucket are first compared
with two leaders of it, and only members that are still in different classes afterwards are compared
directly. A pair of candidates is left out only if both are already in one
class, so classes are those that all verified candidate pairs would give. Pairs of a bucket of up to
``CROWD`` members are written down and verified. In a larger one the members outside its largest class
are compared with some members of that first, so that hardly any with many near texts there are left; then
the join itself leaves out what sizes and parities of the two sets show to be apart.
"""

from __future__ import annotations

import functools
import operator
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import BROADCAST_BYTES, sized, stored, text_key

SHINGLE_WORDS = 5
THRESHOLD = 0.8
BANDS, BAND_ROWS = 24, 6  # a pair at 0.8 is a candidate with probability 0.9993
CROWD = 16
PARITY_WORDS = 16  # enough that sets of hundreds of elements rarely look nearer than they are
CROWD_LEADERS = 4  # members of a crowded bucket's largest root that the others are compared with first
BLOCK = 4096  # members of a crowded bucket that one task compares with all of it
TICKS = 2**32  # in the mean waiting time of one weight step
NEVER = np.iinfo(np.int64).max
DOCS_AT_ONCE = 512

_GOLDEN, _MIX1, _MIX2 = (np.uint64(x) for x in (
    0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))  # constants of splitmix64
_PLACES = 61
_BYTES = np.random.default_rng(7).integers(0, 2**64, (_PLACES, 256), np.uint64)
_BYTES[:, 65:91] = _BYTES[:, 97:123]  # A-Z as a-z
_IS_WORD = np.array([chr(b).isalnum() or b > 127 for b in range(256)])
_FACTORS = np.array([0x9E3779B97F4A7C15 * (2 * i + 1) % 2**64 | 1 for i in range(32)], np.uint64)


def _mix(x: np.ndarray) -> np.ndarray:
    """splitmix64's finaliser."""
    x = (x ^ (x >> np.uint64(30))) * _MIX1
    x = (x ^ (x >> np.uint64(27))) * _MIX2
    return x ^ (x >> np.uint64(31))


def _waits(bits: np.ndarray, width: np.ndarray | int = 1) -> np.ndarray:
    """Exponential waiting times at rate ``width``, in whole ticks: sums of ticks do not depend on
    the order of addition, so a text has one signature whatever batch it is in."""
    uniform = ((bits >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53
    return (np.log(uniform) * (-TICKS / width)).astype(np.int64)


def shingles(texts: list[str | None], n: int = SHINGLE_WORDS) -> tuple[np.ndarray, np.ndarray]:
    """(index of the text, 64-bit hash) of every run of n words of every text, repeats included,
    ordered by text and then hash.

    Words are runs of ASCII letters, digits and non-ASCII characters; A-Z count as a-z. A text of 1
    to n-1 words has one shingle, its whole word list; null texts and texts without words have none.
    A word's hash sums random table entries for its bytes and their places.
    """
    raw = [t.encode() if t else b"" for t in texts]
    buf = np.frombuffer(b" ".join([b"", *raw, b""]), np.uint8)
    inside = _IS_WORD[buf]
    edges = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    starts, ends = edges[::2], edges[1::2]
    if not len(starts):
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    size = ends - starts
    first = np.cumsum(size) - size
    place = np.arange(int(size.sum())) - np.repeat(first, size)
    own = np.add.reduceat(_BYTES[place % _PLACES, buf[inside]], first)
    own = _mix(own + size.astype(np.uint64))
    doc = np.searchsorted(np.cumsum([len(r) + 1 for r in raw]), starts, side="right")
    doc = np.minimum(doc, len(raw) - 1)
    words = np.bincount(doc, minlength=len(raw))
    found = []
    for length in range(1, n + 1):
        has = words == length if length < n else words >= n
        if not has.any() or len(own) < length:
            continue
        whole = len(own) - length + 1
        at = np.flatnonzero(has[doc[:whole]] & (doc[:whole] == doc[length - 1:]))
        total = np.full(len(at), length, np.uint64)
        for i in range(length):
            total += own[at + i] * _FACTORS[i]
        found.append((doc[at], _mix(total)))
    doc, key = (np.concatenate(x) for x in zip(*found))
    if len(found) > 1:
        order = np.argsort(doc, kind="stable")
        doc, key = doc[order], key[order]
    cuts = np.flatnonzero(np.diff(doc)) + 1
    for a, b in zip([0, *cuts], [*cuts, len(key)]):
        key[a:b].sort()
    return doc, key


def bags(texts: list[str | None]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Each text's distinct shingle hashes, sorted, and how often each occurs."""
    doc, key = shingles(texts)
    empty = (np.empty(0, np.uint64), np.empty(0, np.int64))
    if not len(key):
        return [empty] * len(texts)
    new = np.flatnonzero(np.concatenate([[True], (doc[1:] != doc[:-1]) | (key[1:] != key[:-1])]))
    times = np.diff(np.append(new, len(key)))
    owner, distinct = doc[new], key[new]
    cut = np.searchsorted(owner, np.arange(len(texts) + 1))
    return [(distinct[a:b], times[a:b]) for a, b in zip(cut[:-1], cut[1:])]


def signatures(bags: list[tuple[np.ndarray, np.ndarray]], registers: int) -> np.ndarray:
    """Registers of each bag, given as distinct hashes and their whole weights; a row of ``NEVER``
    for an empty bag."""
    regs = np.full((len(bags), registers), NEVER)
    flat = regs.reshape(-1)
    doc = np.repeat(np.arange(len(bags)), [len(h) for h, _ in bags])
    if not len(doc):
        return regs
    item = np.concatenate([h for h, _ in bags]).astype(np.uint64)
    weight = np.concatenate([w for _, w in bags]).astype(np.int64)
    # One process per octave that the weight reaches: steps low+1 .. low+width.
    parts, low, octave = [], 0, 0
    while (reach := np.flatnonzero(weight > low)).size:
        width = max(1, low)
        seed = _mix(item[reach] ^ _mix(np.full(reach.size, octave, np.uint64) + _GOLDEN))
        parts.append((doc[reach], seed, np.full(reach.size, low), np.full(reach.size, width),
                      weight[reach], _waits(_mix(seed + _GOLDEN), width)))
        low, octave = low + width, octave + 1
    doc, seed, low, width, weight, at = (np.concatenate(x) for x in zip(*parts))
    drawn = np.ones(len(doc), np.uint64)
    while True:
        alive = at <= regs.max(axis=1)[doc]
        doc, seed, low, width, weight, at, drawn = (
            x[alive] for x in (doc, seed, low, width, weight, at, drawn))
        if not len(doc):
            break
        unit = width == 1
        again = []
        if unit.any():
            d, s, t, k = doc[unit], seed[unit], at[unit], drawn[unit]
            block = int(min(64, max(1, 20_000 // len(d))))  # few left: several points at once
            steps = k[:, None] + np.arange(block, dtype=np.uint64)
            bits = _mix(s[:, None] + (steps + np.uint64(1)) * _GOLDEN)
            times = t[:, None] + np.concatenate(
                [np.zeros((len(d), 1), np.int64), np.cumsum(_waits(bits[:, :-1]), axis=1)], axis=1)
            where = _mix(_mix(s[:, None] ^ _MIX1) + steps * _MIX2) % np.uint64(registers)
            np.minimum.at(flat, (d[:, None] * registers + where.astype(np.int64)).reshape(-1),
                          times.reshape(-1))
            again.append((d, s, low[unit], width[unit], weight[unit],
                          times[:, -1] + _waits(bits[:, -1]), k + np.uint64(block)))
        if not unit.all():
            big = ~unit
            d, s, l, h, w, t = doc[big], seed[big], low[big], width[big] // 2, weight[big], at[big]
            to_left = (_mix(s ^ _MIX2) & np.uint64(1)).astype(bool)
            later = t + _waits(_mix(s ^ _GOLDEN), h)
            for side in (0, 1):
                child = _mix(s + _FACTORS[side + 1:side + 2])
                start = l + side * h
                point = np.where(to_left == (side == 0), t, later)
                used = start < w
                again.append((d[used], child[used], start[used], h[used], w[used], point[used],
                              np.ones(int(used.sum()), np.uint64)))
        doc, seed, low, width, weight, at, drawn = (np.concatenate(x) for x in zip(*again))
    return regs


def band_keys(texts: list[str | None], bands: int = BANDS, rows: int = BAND_ROWS) -> list:
    """For each text the keys of its bands; none without words."""
    own = bags(texts)
    bits = signatures(own, bands * rows).view(np.uint64).reshape(len(texts), bands, rows)
    key = np.broadcast_to(np.arange(bands, dtype=np.uint64), bits.shape[:2]).copy()
    for i in range(rows):
        key = _mix(key * _FACTORS[i] + bits[:, :, i])
    return [list(k.view(np.int64)) if len(b[0]) else [] for k, b in zip(key, own)]


def weighted_jaccard(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Sum of smaller over sum of larger weights of two bags; 0 if both are empty."""
    _, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    common = int(np.minimum(a[1][i], b[1][j]).sum())
    total = int(a[1].sum() + b[1].sum()) - common
    return common / total if total else 0.0


def _sign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in batches:
        frame = frame.drop_duplicates("node")
        for at in range(0, len(frame), DOCS_AT_ONCE):
            part = frame.iloc[at:at + DOCS_AT_ONCE]
            yield pd.DataFrame({"node": part["node"], "keys": band_keys(list(part["text"]))})


def parities(elements: np.ndarray) -> np.ndarray:
    """For each of 64 * ``PARITY_WORDS`` cells whether it holds an odd number of elements, as whole numbers of
    64 bits. Two sets differ in at least as many elements as their parities differ in bits."""
    odd = np.bincount((elements & np.uint64(64 * PARITY_WORDS - 1)).astype(np.int64),
                      minlength=64 * PARITY_WORDS) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view("<i8")


def _gram_sets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Each bag as a set, the n-th copy of a shingle being an element of its own, and its parities."""
    for frame in batches:
        for at in range(0, len(frame), DOCS_AT_ONCE):
            part = frame.iloc[at:at + DOCS_AT_ONCE]
            sets = []
            for keys, times in bags(list(part["text"])):
                copy = np.arange(int(times.sum())) - np.repeat(np.cumsum(times) - times, times)
                sets.append(_mix(np.repeat(keys, times) + copy.astype(np.uint64) * _GOLDEN))
            yield pd.DataFrame({"node": part["node"], "grams": [x.view(np.int64) for x in sets],
                                "parity": [parities(x) for x in sets]})


def _verify(threshold: float):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in batches:
            for at in range(0, len(frame), DOCS_AT_ONCE):
                part = frame.iloc[at:at + DOCS_AT_ONCE]
                text = {**dict(zip(part["a"], part["text_a"])), **dict(zip(part["b"], part["text_b"]))}
                bag = dict(zip(text, bags(list(text.values()))))
                keep = [weighted_jaccard(bag[a], bag[b]) >= threshold
                        for a, b in zip(part["a"], part["b"])]
                yield part.loc[keep, ["a", "b"]]
    return run


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b), the root being the smallest node of its
    component. In each step a node, and the root it has so far, take the smallest root among its
    neighbours; then labels jump along roots, until nothing changes."""
    both = stored(links.select("a", "b").union(links.select("b", "a")).distinct(), "links")
    labels = stored(both.groupBy(F.col("a").alias("node"))
                    .agg(F.least(F.first("a"), F.min("b")).alias("root")), "roots")
    nodes = labels.count()
    while True:
        known = sized(labels, nodes, 96)
        seen = both.join(known.withColumnRenamed("node", "b"), "b").select("a", F.col("root").alias("near"))
        offers = seen.join(known.withColumnRenamed("node", "a"), "a").filter("near < root")
        best = (offers.select(F.explode(F.array("a", "root")).alias("node"), "near")
                .groupBy("node").agg(F.min("near").alias("near")))
        met = labels.join(best, "node", "left").select("node", "root", F.coalesce(F.least("root", "near"), "root").alias("to"))
        met = stored(met, "offers")
        jump = met.select(F.col("node").alias("to"), F.col("to").alias("far"))
        new = stored(met.join(sized(jump, nodes, 96), "to").select(
            "node", F.col("far").alias("root"), (F.col("root") != F.col("far")).alias("moved")), "roots")
        labels = new.select("node", "root")
        if new.filter("moved").isEmpty():
            return labels


def _apart(left: str, right: str, threshold: float) -> Column:
    """Whether sizes and parities of two sets show that they are not near. Of two sets that are near at
    most a share of their elements is in one alone, and parities differ in no more bits than that."""
    most = (F.col(f"{left}.size") + F.col(f"{right}.size")) * ((1 - threshold) / (1 + threshold)) + 1e-6
    odd = functools.reduce(operator.add, (
        F.bit_count(F.col(f"{left}.p{i}").bitwiseXOR(F.col(f"{right}.p{i}"))) for i in range(PARITY_WORDS)))
    return (F.abs(F.col(f"{left}.size") - F.col(f"{right}.size")) > most) | (odd > most)


def _with_main(crowd: DataFrame) -> DataFrame:
    """Crowded buckets of several roots, with the largest root of each, how many members are of others,
    and a few members of the largest root, others in each bucket."""
    leaders = F.array(*[F.min_by("node", F.xxhash64("key", "node", F.lit(i))) for i in range(CROWD_LEADERS)])
    main = (crowd.groupBy("key", "root").agg(F.count("*").alias("members"), leaders.alias("leaders"))
            .groupBy("key").agg(F.max_by(F.struct("root", "leaders"), F.struct("members", "root")).alias("main"),
                                (F.sum("members") - F.max("members")).alias("minors")).filter("minors > 0"))
    return (crowd.join(main.select("key", F.col("main.root").alias("main"), "main.leaders", "minors"), "key")
            .withColumn("minor", F.col("root") != F.col("main")))


def _near_in_crowds(crowd: DataFrame, texts: DataFrame, threshold: float) -> DataFrame:
    """Links (a, b) between roots some of whose members are near and share a crowded bucket; one link
    for two roots, however many of their members are near.

    First the members of a bucket's smaller roots are compared with some of its largest root. A root that
    is near one of them takes its label, for both are in one class; who has few near texts in the largest
    root is left, and is compared with all of the bucket that still has another label. Sizes and parities
    leave out pairs that differ in too many elements; only for the rest are the sets fetched and compared.
    Buckets are broadcast if all of them are small; else the others of a bucket are dealt into blocks,
    each of which meets the bucket."""
    nodes = crowd.select("node").distinct()
    sets = stored(texts.join(nodes, "node", "left_semi").mapInPandas(
        _gram_sets, "node binary, grams array<long>, parity array<long>"), "grams")
    words = [F.col("parity")[i].alias(f"p{i}") for i in range(PARITY_WORDS)]
    shapes = stored(sets.select("node", F.size("grams").alias("size"), *words), "shapes")

    def near(pairs: DataFrame) -> DataFrame:
        """Links (a, b) of roots by pairs (a, b, low, high) of nodes and their roots."""
        left = sets.select(F.col("node").alias("a"), F.col("grams").alias("grams_a"))
        right = sets.select(F.col("node").alias("b"), F.col("grams").alias("grams_b"))
        common = F.size(F.array_intersect("grams_a", "grams_b"))
        return stored(pairs.join(left, "a").join(right, "b").filter(
            common / (F.size("grams_a") + F.size("grams_b") - common) >= threshold
        ).select(F.col("low").alias("a"), F.col("high").alias("b")).distinct(), "near")

    ends = [F.least("root", "main").alias("low"), F.greatest("root", "main").alias("high")]
    tried = (_with_main(crowd).filter("minor")
             .select(F.col("node").alias("a"), F.explode(F.array_distinct("leaders")).alias("b"), *ends).distinct())
    one, two = shapes.withColumnRenamed("node", "a").alias("one"), shapes.withColumnRenamed("node", "b").alias("two")
    close = stored(tried.join(one, "a").join(two, "b").filter(~_apart("one", "two", threshold))
                   .select("a", "b", "low", "high"), "close")
    led = near(close)
    labels = components(led)
    renamed = labels.select(F.col("node").alias("root"), F.col("root").alias("label"))
    crowd = crowd.join(sized(renamed, renamed.count(), 96), "root", "left").select(
        "key", "node", F.coalesce("label", "root").alias("root"))

    slim = stored(_with_main(crowd).drop("main", "leaders").join(shapes, "node"), "crowds")
    one, two = slim.filter("minor"), slim
    rows, row_bytes = slim.count(), 120 + 8 * PARITY_WORDS
    if rows * row_bytes > BROADCAST_BYTES:
        blocks = F.ceil(F.col("minors") / BLOCK).cast("int")
        one = one.withColumn("block", F.pmod(F.xxhash64("node"), blocks).cast("int"))
        two = two.withColumn("block", F.explode(F.sequence(F.lit(0), blocks - 1)))
    else:
        one, two = one.withColumn("block", F.lit(0)), F.broadcast(two.withColumn("block", F.lit(0)))
    one, two = one.alias("one"), two.alias("two")
    maybe = ((F.col("one.key") == F.col("two.key")) & (F.col("one.block") == F.col("two.block"))
             & (~F.col("two.minor") | (F.col("one.root") < F.col("two.root"))) & ~_apart("one", "two", threshold))
    pairs = stored(one.join(two, maybe).select(
        F.col("one.node").alias("a"), F.col("two.node").alias("b"),
        F.least("one.root", "two.root").alias("low"), F.greatest("one.root", "two.root").alias("high"),
    ).distinct(), "maybe")
    return led.union(near(pairs))


def _text_classes(filled: DataFrame, threshold: float) -> DataFrame:
    """(node, least_id, class_key, class_id) for each distinct text of ``filled`` (doc_id, text, node)."""
    signed = stored(filled.select("node", "text").mapInPandas(_sign, "node binary, keys array<long>")
                    .filter("size(keys) > 0").dropDuplicates(["node"]), "bands")
    rows = signed.select("node", F.explode("keys").alias("key"))
    shared = (rows.groupBy("key").agg(F.count("*").alias("n"), F.min("node").alias("low"),
                                      F.max("node").alias("high"))
              .filter("n > 1").drop("n"))
    buckets = stored(rows.join(shared, "key"), "buckets")

    wanted = buckets.select("node").distinct()
    texts = stored(filled.select("node", "text")
                   .join(sized(wanted, wanted.count(), 64), "node", "left_semi")
                   .groupBy("node").agg(F.first("text").alias("text")), "texts")

    def verified(pairs: DataFrame) -> DataFrame:
        left = texts.select(F.col("node").alias("a"), F.col("text").alias("text_a"))
        right = texts.select(F.col("node").alias("b"), F.col("text").alias("text_b"))
        return pairs.join(left, "a").join(right, "b").mapInPandas(
            _verify(threshold), "a binary, b binary")

    def ordered(frame: DataFrame, one: str, other: str) -> DataFrame:
        return frame.filter(f"{one} <> {other}").select(
            F.least(one, other).alias("a"), F.greatest(one, other).alias("b"))

    tested = stored(ordered(buckets, "node", "low").union(ordered(buckets, "node", "high"))
                    .distinct(), "pairs")
    links = stored(verified(tested), "near")
    roots = components(links)
    placed = buckets.select("key", "node").join(sized(roots, roots.count(), 96), "node", "left").withColumn(
        "root", F.coalesce("root", "node"))
    mixed = (placed.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high"),
                                       F.count("*").alias("n")).filter("low <> high"))
    open_rows = stored(placed.join(mixed.select("key", "n"), "key"), "open")
    small, crowd = open_rows.filter(F.col("n") <= CROWD), open_rows.filter(F.col("n") > CROWD)
    other = small.select("key", F.col("node").alias("node2"), F.col("root").alias("root2"))
    pairs = ordered(small.join(other, "key").filter("root < root2"), "node", "node2")
    untested = pairs.distinct().join(tested, ["a", "b"], "left_anti")
    found = stored(verified(untested).union(_near_in_crowds(crowd, texts, threshold)), "near")
    if not found.isEmpty():
        roots = components(links.union(found))

    ids = filled.groupBy("node").agg(F.min("doc_id").alias("least_id"))
    classes = ids.join(roots, "node", "left").withColumn("class_key", F.coalesce("root", "node"))
    names = classes.groupBy("class_key").agg(F.min("least_id").alias("class_id"))
    return stored(classes.select("node", "least_id", "class_key").join(names, "class_key"), "classes")


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", "text", text_key("text").alias("node"))


def near_duplicate_classes(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, class_id), one row per row of ``docs`` (doc_id, text).

    ``class_id`` is the smallest doc_id of the class. Equal texts, empty ones too, are one class;
    texts without words are near nothing else; a null text is a class of its own. An empty table
    gives no rows. Other columns are not read.
    """
    keyed = _keyed(docs)
    classes = _text_classes(keyed.filter("node IS NOT NULL"), threshold)
    return (keyed.select("doc_id", "node").join(classes.select("node", "class_id"), "node", "left")
            .select("doc_id", F.when(F.col("node").isNull(), F.col("doc_id"))
                    .otherwise(F.col("class_id")).alias("class_id")))


def keep_one_each(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with one row left of each class: the row with the smallest doc_id (one of them where
    rows repeat). Rows with null text stay. All columns are kept."""
    keyed = _keyed(docs).filter("node IS NOT NULL")
    classes = _text_classes(keyed, threshold)
    pick = F.min(F.struct(F.col("least_id").isNull(), "least_id", "node"))
    kept = (classes.groupBy("class_key").agg(pick.alias("p"))
            .select(F.col("p.node").alias("node"), F.col("p.least_id").alias("kept_id"),
                    F.lit(True).alias("first")))
    rows = (keyed.groupBy("node", "doc_id").agg(F.count("*").alias("n")).join(kept, "node", "left")
            .withColumn("stays", F.coalesce(
                F.col("first") & F.col("doc_id").eqNullSafe(F.col("kept_id")), F.lit(False))))
    changed = stored(rows.filter("NOT stays OR n > 1").select(
        F.col("node").alias("__node"), F.col("doc_id").alias("__id"), "stays"), "leaving")
    changed = sized(changed, changed.count(), 96)
    tagged = docs.withColumn("__key", text_key("text"))
    same = (F.col("__key") == F.col("__node")) & F.col("doc_id").eqNullSafe(F.col("__id"))
    once = tagged.join(changed, same, "left_anti")
    repeated = changed.filter("stays")
    if not repeated.isEmpty():
        again = tagged.join(repeated, same, "left_semi").dropDuplicates(["__key"])
        once = once.unionByName(again)
    return once.drop("__key")
