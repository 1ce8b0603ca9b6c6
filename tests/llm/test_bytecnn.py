"""The network against plain loops and difference quotients; held-out accuracy."""

import zlib

import inputs
import numpy as np
import pytest

from ledgerloom.llm import bytecnn, queries

SF = "/root/testdata/sf0.1"


def random_net(seed=3, kind=np.float64):
    rng = np.random.default_rng(seed)
    return {k: rng.normal(0, 0.4, v.shape).astype(kind) for k, v in bytecnn.fresh().items()}


def plain_score(net, text):
    """One text, one filter and one place at a time."""
    raw = (text or "").encode()
    rows, at = [], 0
    while True:
        rows.append(raw[at:at + 256].ljust(256, b"\0"))
        if at + 256 >= len(raw):
            break
        at += 192
    units = []
    for row in rows:
        vectors = net["bytes"][list(row)]
        best = [max(sum(vectors[p + k] @ net["filters"][k][:, f] for k in range(bytecnn.WIDTH))
                    for p in range(256 - bytecnn.WIDTH + 1)) for f in range(bytecnn.FILTERS)]
        seen = np.maximum(np.array(best) + net["filter_bias"], 0)
        units.append(np.maximum(seen @ net["hidden"] + net["hidden_bias"], 0))
    features = np.concatenate([np.max(units, axis=0), np.mean(units, axis=0)])
    return 1 / (1 + np.exp(-(features @ net["last"] + net["last_bias"][0])))


def test_scores_equal_plain_loops():
    net = random_net()
    texts = [None, "", "a", "é" * 200, inputs.prose(60, 1), "x" * 256, "x" * 257, "x" * 449]
    got = bytecnn.scores(net, texts)
    assert got == pytest.approx([plain_score(net, t) for t in texts], abs=1e-9)


def test_gradient_equals_difference_quotients():
    net = random_net(5)
    rows = [bytecnn.chunks(t.encode()) for t in (inputs.prose(80, 2), "short one", inputs.prose(40, 3))]
    owner = np.repeat(np.arange(3), [len(r) for r in rows])
    data = np.concatenate(rows), owner, np.array([1, 0, 1])
    _, grad = bytecnn.gradients(net, *data)
    rng = np.random.default_rng(0)
    for name, values in net.items():
        flat, own = values.reshape(-1), grad[name].reshape(-1)
        places = np.argsort(-np.abs(own))[:4].tolist() + rng.integers(0, flat.size, 3).tolist()
        for i in places:
            before = flat[i]
            losses = []
            for step in (1e-6, -1e-6):
                flat[i] = before + step
                losses.append(bytecnn.gradients(net, *data)[0])
            flat[i] = before
            assert (losses[0] - losses[1]) / 2e-6 == pytest.approx(own[i], abs=1e-5, rel=1e-3), name


def test_chunks_cover_every_byte_with_overlap():
    for size in (0, 1, 255, 256, 257, 448, 449, 5000):
        raw = bytes(np.random.default_rng(size).integers(1, 256, size, np.uint8))
        rows = bytecnn.chunks(raw)
        seen = bytearray((len(rows) - 1) * bytecnn.STEP + bytecnn.CHUNK)
        for i, row in enumerate(rows):
            seen[i * bytecnn.STEP:i * bytecnn.STEP + bytecnn.CHUNK] = row.tobytes()
        assert bytes(seen[:size]) == raw and not any(seen[size:])
    assert bytecnn.CHUNK - bytecnn.STEP >= bytecnn.WIDTH - 1  # no run of bytes lies between chunks


def test_late_bytes_count_and_batches_do_not():
    net = random_net(7)
    long = inputs.prose(20_000, 4)
    one, other = bytecnn.scores(net, [long, long + "ÿ" * 300])
    assert one != other
    texts = [inputs.prose(n, n) for n in (3, 900, 50, 4000)]
    assert bytecnn.scores(net, texts) == pytest.approx(bytecnn.scores(net, texts, at_once=3), abs=1e-12)


def test_odd_inputs(spark):
    texts = inputs.odd_texts()
    ids = [None, 5, 5, *range(10, 7 + len(texts))]
    docs = inputs.documents(spark, texts, ids)
    labels = spark.createDataFrame(
        [(5, 1, 0, "x"), (5, 0, 0, "x"), (11, None, 0, "x"), (12, 7, 1, "x"), (None, 1, 0, "x"), (13, 1, 0, "x"),
         (14, 0, 1, "x"), (999, 1, 1, "x")], "doc_id long, quality int, toxic int, text string")
    got = bytecnn.scored(docs, labels).collect()
    assert len(got) == len(texts)
    for row in got:
        assert 0 <= row.score <= 1 and row.predicted == (row.score >= 0.3)
        assert row.held_out == (row.doc_id is not None and zlib.crc32(str(row.doc_id).encode()) % 5 == 0)
    by_id = {}
    for row in got:
        by_id.setdefault(row.doc_id, []).append(row.score)
    assert len(by_id[5]) == 2


def test_no_lessons_and_no_rows(spark):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    docs = inputs.documents(spark, ["some text", None])
    assert [r.score for r in bytecnn.scored(docs, labels).collect()] == [0.5, 0.5]
    assert bytecnn.scored(inputs.documents(spark, []), labels).collect() == []


def test_lessons_leave_out_held_out_documents(spark):
    docs = inputs.documents(spark, [f"text {i}" for i in range(200)])
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(200)], "doc_id long, quality int, toxic int")
    taught = {r[0].tobytes().rstrip(b"\0").decode() for r in bytecnn.lessons(docs, labels)}
    assert taught == {f"text {i}" for i in range(200) if zlib.crc32(str(i).encode()) % 5}


def test_held_out_documents_are_judged_well(spark):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    rows = [r for r in queries.op13_quality_score(spark, SF).collect() if r.held_out and r.doc_id in labels]
    good = [r.score for r in rows if labels[r.doc_id] == 1]
    bad = [r.score for r in rows if labels[r.doc_id] == 0]
    order = np.argsort(np.argsort(good + bad))
    area = (order[:len(good)].sum() - len(good) * (len(good) - 1) / 2) / (len(good) * len(bad))
    assert len(good) > 500 and len(bad) > 100 and area > 0.95
    assert np.mean(np.array(good) >= 0.3) > 0.98 and np.mean(np.array(bad) >= 0.3) < 0.3
