"""The filtered join against every block with every template, in SQL and in Python."""

import re

import duckdb
import inputs
import pandas as pd

from ledgerloom.llm import licenses
from ledgerloom.llm.queries import QUERIES

TEMPLATES = (
    *licenses.TEMPLATES, licenses.Template("short", "one two"), licenses.Template("mit", "a b c d e f g h i j"),
    licenses.Template("none", "..."))


def words(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def plain(text, threshold):
    own = words(text)
    places = [(i, label) for phrase, label in licenses.PHRASES for i in range(len(own))
              if own[i:i + len(phrase.split())] == phrase.split()]
    base = {label for _, label in places}
    more, best = set(), 0.0
    for line in (text or "").split("\n") if text is not None else []:
        for t in TEMPLATES:
            wanted = set(words(t.text))
            if wanted and len(wanted & set(words(line))) >= threshold * len(wanted) - 1e-9:
                more.add(t.label)
                best = max(best, len(wanted & set(words(line))) / len(wanted))
    starts = [i for i, _ in places]
    return (len(own), len(places), min(starts, default=None), max(starts, default=None), ",".join(sorted(base)),
            ",".join(sorted(base | more)), 1.0 if places else best)


def texts():
    notice = licenses.TEMPLATES[0].text
    return [
        "The MIT License. MIT license mit\nlicense", "general public license", "Apache\n\nLicense, Version 2.0",
        notice, notice.upper() + " and more", " ".join(notice.split()[:12]), " ".join(notice.split()[:18]),
        "x one y two", "one\ntwo", "a b c d e f g h", "j i h g f e d c b a a a", "a b c d e f g", "licenſe mit licensé",
        *inputs.odd_texts(), "license " * 3000, "mit license " * 500]


def row(r):
    return (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels, r.labels, r.score)


def test_against_every_pair(spark):
    docs = inputs.documents(spark, texts())
    got = {r.doc_id: row(r) for r in licenses.scan(docs, TEMPLATES, 0.5).collect()}
    assert got == {i: plain(t, 0.5) for i, t in enumerate(texts())}


def test_sql_gives_the_same(spark):
    con = duckdb.connect()
    con.register("frame", pd.DataFrame({"doc_id": range(len(texts())), "text": texts()}))
    con.execute("CREATE VIEW documents AS SELECT * FROM frame")
    names = "doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score"
    want = con.sql(f"SELECT {names} FROM ({licenses.oracle(TEMPLATES)}) ORDER BY doc_id").fetchall()
    docs = inputs.documents(spark, texts())
    assert [tuple(r) for r in licenses.scan(docs, TEMPLATES).orderBy("doc_id").collect()] == want


def test_repeated_missing_and_no_rows(spark):
    docs = inputs.documents(spark, ["mit license", "mit license", None], [5, 5, None])
    assert licenses.scan(docs).filter("n_base = 1").count() == 2 and licenses.scan(docs).count() == 3
    assert licenses.scan(docs.limit(0)).count() == 0 and licenses.scan(docs, ()).count() == 3


def test_wrapped_notices_are_found(spark):
    notices = [t for t in licenses.TEMPLATES if t.label in ("mit", "gpl", "bsd", "mpl", "cc")]
    texts, labels = [], []
    for t in notices:
        for width in (1, 4, 6):
            for mark, end in (("", "\n"), ("# ", "\r\n"), (" * ", "\n\n")):
                own = t.text.split()
                rows = [mark + " ".join(own[i:i + width]) for i in range(0, len(own), width)]
                texts.append(end.join([inputs.prose(90), *rows, inputs.prose(90)]))
                labels.append(t.label)
    texts += [inputs.prose(900), "\n\n", "\n", "", None, "\n" + " ".join(notices[0].text.split()[:12]) + "\nx"]
    labels += [""] * 6
    got = {r.doc_id: r.labels for r in licenses.scan(inputs.documents(spark, texts), wrapped=True).collect()}
    assert got == dict(enumerate(labels))


def test_short_notices(spark):
    docs = inputs.documents(spark, ["x\nLicensed under CC BY-NC 4.0.\ny", "licensed under\ncc by-sa\n4.0", "by 4.0"])
    got = licenses.scan(docs, (*licenses.TEMPLATES, *licenses.SHORT_NOTICES), wrapped=True).orderBy("doc_id")
    assert [r.labels for r in got.collect()] == ["cc", "cc", ""]


def test_wrapped_notices_in_the_registered_query(spark, tmp_path):
    notice = licenses.TEMPLATES[4].text.split()
    inputs.documents(spark, [" ".join(notice[:9]) + "\n" + " ".join(notice[9:])]).write.parquet(f"{tmp_path}/documents.parquet")
    assert QUERIES["op1_license_scan"](spark, str(tmp_path)).first().labels == "bsd"
