"""Counts against a plain reading of their definitions; verdicts on lines and documents."""

import re

import inputs

from ledgerloom.llm import line_rules
from ledgerloom.llm.common import table


def plain(text):
    text = text or ""
    own = re.findall(r"[^ \t\n\x0b\x0c\r]+", text)
    windows = [tuple(own[i:i + 3]) for i in range(len(own) - 2)]
    inside = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(3)}
    rows = text.split("\n")
    duplicates = sum(bool(re.search(r"[^ \t\n\x0b\x0c\r]", r)) and r in rows[:i] for i, r in enumerate(rows))
    return (len(own), sum(map(len, own)), sum(c in "#*$%&|<>" for c in text), duplicates, len(inside),
            len(own) < 50 or 100 * len(inside) > 50 * len(own))


def test_counts(spark):
    texts = [*[t for t in inputs.odd_texts() if len(t or "") < 9999], "a b c a b c x\nx y\nx y\n \n \n",
             "a\xa0b   c", inputs.prose(120, 4) + "\n" + inputs.prose(30, 4)]
    got = {r.doc_id: r for r in line_rules.judged(inputs.documents(spark, texts)).collect()}
    for i, text in enumerate(texts):
        r = got[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == plain(text)
        assert not (r.base_failed and r.kept)


def test_lines():
    def rule(line):
        return line_rules.failed_rule(line, line.split())

    assert rule("Home | News | Sport | About") == "navigation"
    assert rule("de%%% la&&& que$$$ vi###") == "symbols"
    assert rule("BUY THIS NOW OR NEVER!") == "shouting"
    assert rule("no " * 12) == "repetition"
    assert rule("a line that goes on and on without end") == "punctuation"
    assert rule("We use them, see our Cookie Policy.") == "boilerplate"
    assert rule("An ordinary sentence, with a comma and an end.") is None
    assert rule("Title") is None


def test_labelled_documents(spark):
    docs, labels = (table(spark, "/root/testdata/sf0.01", t) for t in ("documents", "labels"))
    rows = line_rules.judged(docs).join(labels, "doc_id").collect()
    good = [r for r in rows if r.quality == 1 and not r.base_failed]
    bad = [r for r in rows if r.quality == 0]
    assert all(r.kept for r in good) and not any(r.kept for r in bad) and good and bad


def test_cleaned_documents(spark):
    good = inputs.prose(90, 2)
    texts = [good, good + "\nHome | News | Sport | About", inputs.prose(20, 3) + "\n" + "A | B | C | D | E\n" * 20, *inputs.odd_texts()]
    docs = inputs.documents(spark, texts)
    got = {r.doc_id: r for r in line_rules.cleaned(docs).collect()}
    assert line_rules.cleaned(docs).columns == docs.columns
    assert got[0].text == got[1].text == good and got[1].n_chars == len(good)
    assert 2 not in got and line_rules.cleaned(docs.limit(0)).count() == 0
