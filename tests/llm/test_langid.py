"""Accuracy on held-out documents, and what is learned from."""

import zlib

import inputs
import zstandard

from ledgerloom.llm import langid
from ledgerloom.llm.common import table


def test_held_out_accuracy(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    rows = langid.identified(docs).join(docs.select("doc_id", "lang", "text"), "doc_id").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    tested = [r for r in rows if r.held_out and r.lang and r.text]
    assert sum(r.lang == r.lang_pred for r in tested) >= 0.97 * len(tested) and len(tested) > 100
    assert all(0 <= r.score <= 1 for r in rows)
    assert all(r.lang_pred == "und" for r in rows if r.text is None)


def test_learns_only_from_allowed_rows(spark):
    texts = [f"wordone{'x' * (i % 5)} another sentence here {i}" for i in range(40)]
    langs = ["aa" if zlib.crc32(str(i).encode()) % 4 == 2 else "bb" for i in range(40)]
    assert set(langid.fitted(inputs.documents(spark, texts, None, langs))) == {"bb"}


def test_odd_rows(spark):
    texts = inputs.odd_texts()
    docs = inputs.documents(spark, texts, None, ["x" if i % 2 else "y" for i in range(len(texts))])
    got = {r.doc_id: r for r in langid.identified(docs).collect()}
    for i, text in enumerate(texts):
        assert (got[i].lang_pred == "und") == (not any(c.isalpha() for c in text or ""))
    unlabelled = inputs.documents(spark, ["some text"])
    assert langid.identified(unlabelled).first().lang_pred == "und"
    assert langid.identified(docs.limit(0)).count() == 0
    same = inputs.documents(spark, ["a b c"] * 3, [1, 1, None], ["x", "y", "x"])
    assert langid.identified(same).count() == 3


def test_narrow_margins_are_rejected(spark):
    models = {"a": langid.normalised(inputs.prose(900, 1)), "b": langid.normalised(inputs.prose(900, 1))}
    assert langid.identified(inputs.documents(spark, [inputs.prose(100, 9)]), models).first().rejected


def test_languages_of_long_texts_only_are_learned(spark):
    ids = [i for i in range(80) if zlib.crc32(str(i).encode()) % 4 != 2][:16]
    texts = [inputs.prose(9_000, i, 300) if k % 2 else f"quelques mots en plus numéro {'z' * k}" for k, i in enumerate(ids)]
    docs = inputs.documents(spark, texts, ids, ["long" if k % 2 else "fr" for k in range(16)])
    models = langid.fitted(docs)
    assert set(models) == {"long", "fr"} and all(len(m) <= langid.DICTIONARY_BYTES + 100 for m in models.values())
    assert {r.lang_pred for r in langid.identified(docs, models).collect() if r.doc_id in ids[1::2]} == {"long"}


def test_choice_is_the_smallest_size(spark):
    docs = table(spark, inputs.SF_DIR, "documents")
    models = langid.fitted(docs)
    texts = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}

    def size(text, model):
        own = zstandard.ZstdCompressionDict(model, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        plain = "".join(c if c.isalpha() or c in "\u0300\u0301" else " " for c in text.lower())
        return len(zstandard.ZstdCompressor(level=langid.LEVEL, dict_data=own, write_checksum=False,
                                            write_content_size=False, write_dict_id=False)
                   .compress(" ".join(f"<{plain}>".split())[1:-1].encode()))

    for row in langid.identified(docs, models).collect():
        text = texts[row.doc_id]
        if text is None or not any(map(str.isalpha, text)):
            assert (row.lang_pred, row.score, row.rejected) == ("und", 0.0, True)
            continue
        sizes = {lang: size(text, model) for lang, model in models.items()}
        best, second = sorted(sizes.values())[:2]
        assert row.lang_pred == next(lang for lang in models if sizes[lang] == best)
        assert abs(row.score - (1 - best / second)) < 1e-12
        assert row.rejected == (row.score < langid.MIN_MARGIN)


def test_ties_go_to_the_language_with_more_labels(spark):
    same = langid.normalised(inputs.prose(200, 3))
    got = langid.identified(inputs.documents(spark, [inputs.prose(60, 3)]), {"more": same, "less": same}).first()
    assert (got.lang_pred, got.score, got.rejected) == ("more", 0.0, True)
