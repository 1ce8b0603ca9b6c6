"""Leaks against brute force over all windows."""

import re
from collections import Counter

import inputs

from ledgerloom.llm import decontam
from ledgerloom.llm.common import table


def words(text):
    return [w for w in re.split(r"[\W_]+", (text or "").lower()) if w]


def bag(own, size):
    return Counter(tuple(own[i:i + size]) for i in range(len(own) - size + 1))


def brute(docs, items):
    found = {}
    for doc_id, text in docs:
        own = words(text)
        for item_id, item in items:
            wanted = words(item)
            size = min(5, len(wanted))
            if not wanted or text is None or len(own) < size:
                continue
            goal = bag(wanted, size)
            if not set(goal) & set(bag(own, size)):
                continue
            for start in range(max(1, len(own) - len(wanted) + 1)):
                have = bag(own[start:start + len(wanted)], size)
                common = sum((have & goal).values())
                value = common / (sum(have.values()) + sum(goal.values()) - common)
                if value >= 0.8 and value > found.get((doc_id, item_id), (0, 0))[0]:
                    found[doc_id, item_id] = (value, start)
    return found


def result(docs, items):
    return {(r.doc_id, r.item_id): (r.similarity, r.start_word)
            for r in decontam.contaminated(docs, items).collect()}


def same(got, want):
    assert set(got) == set(want)
    for key, (value, _) in want.items():
        assert abs(got[key][0] - value) < 1e-12


def items_of(spark, rows):
    return spark.createDataFrame([(*r, "x") for r in rows], "item_id long, text string, node string")


def test_given_documents(spark):
    docs, items = (table(spark, inputs.SF_DIR, t) for t in ("documents", "benchmark"))
    want = brute([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()],
                 [(r.item_id, r.text) for r in items.collect()])
    same(result(docs, items), want)


def test_edits_shifts_and_short_items(spark):
    item = inputs.prose(40, 3, 5000).replace("\n", " ")
    own = item.split()
    texts = [
        "before it " + item + " after", " ".join(own[:38]), " ".join(own[2:]), " ".join(own[:30]),
        " ".join([*own[:20], "changed", *own[21:]]), " ".join([*own[:20], "more", *own[20:]]),
        "x y z " + " ".join(own[1:]) + " q", item + " " + item, *inputs.odd_texts(),
        "one two three and so on", "three two one", "the very same four", "same same same same same same same"]
    rows = [(1, item), (2, "one two three"), (3, "the very same four"), (4, None), (5, ""), (6, "one"),
            (7, "same same same same same same"), (8, item), (1, item.upper())]
    docs, items = inputs.documents(spark, texts), items_of(spark, rows)
    want = brute(list(enumerate(texts)), rows)
    same(result(docs, items), want)
    leaking = {d for d, _ in want}
    clean = decontam.without_leaks(docs, items)
    assert clean.columns == docs.columns
    assert sorted(r.doc_id for r in clean.collect()) == [i for i in range(len(texts)) if i not in leaking]


def test_fingerprints_within_the_radius_share_a_probe(spark):
    rows = spark.range(200).selectExpr("xxhash64(id) AS a", "id").selectExpr(
        "a", "a ^ shiftleft(shiftleft(1L, 24) - 1, cast(id % 40 AS int)) AS b")
    cells = rows.select(decontam._block_rows(rows.a, False).alias("one"),
                        decontam._block_rows(rows.b, True).alias("two"))
    assert cells.filter("arrays_overlap(one, two)").count() == 200


def test_fingerprint_is_the_majority(spark):
    rows = spark.createDataFrame([([3, 5, -1],), ([-1, -2],), ([7],)], "g array<long>")
    got = [r.code for r in rows.select(decontam.fingerprint(rows.g).alias("code")).collect()]
    assert got == [7, -2, 7]


def test_empty_tables(spark):
    docs, items = inputs.documents(spark, ["a b c d e f"]), items_of(spark, [(1, "a b c d e f")])
    assert result(docs, items.limit(0)) == {} and result(docs.limit(0), items) == {}
    assert decontam.without_leaks(docs, items.limit(0)).count() == 1
