import zlib

import numpy as np
import pytest

from pagemart.llm import langid

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    docs = {r.doc_id: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = langid.op5_language_id(spark, SF).collect()
    assert {r.doc_id for r in got} == set(docs) and len(got) == len(docs)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 for r in got)
    aside = [r for r in got if r.held_out and r.lang_pred != "und"]
    assert sum(r.lang_pred == docs[r.doc_id].lang for r in aside) >= 0.98 * len(aside)
    assert all(r.lang_pred != "und" or not any(c.isalpha() for c in docs[r.doc_id].text) for r in got)


def test_three_languages_of_a_family_and_a_stranger():
    texts = {"de": "der die das und nicht", "nl": "het een van niet zijn", "en": "the and not with was", "xx": "qoq zuz kik wow"}
    rng = np.random.default_rng(0)
    labels = [lang for lang in texts for _ in range(40)]
    made = [" ".join(rng.choice(texts[lang].split(), 12)) for lang in labels]
    model = langid.fit(labels, np.array([langid.features(t) for t in made]))
    assert model.families == {"germanic": ["de", "en", "nl"], "xx": ["xx"]}
    for lang, words in texts.items():
        found, score = model.predict(words)
        assert found == lang and 0.5 < score <= 1


@pytest.mark.parametrize("text", [None, "", "12 34 !?", "\n"])
def test_no_letter(text):
    model = langid.fit(["en", "fr"], np.array([langid.features("the"), langid.features("le")]))
    assert model.predict(text) == ("und", 0.0)


def test_long_text_in_chunks_counts_each_gram_once(monkeypatch):
    text = "the quick Fox é " * 500
    whole = langid.features(text)
    monkeypatch.setattr(langid, "CHUNK", 97)
    assert np.array_equal(langid.features(text), whole)


def test_odd_rows(spark):
    rows = [(1, "the and of", "en"), (1, "the and of", "en"), (None, "le la", "fr"), (2, None, "fr"), (3, "", None), (4, "et dans le", "fr"), (5, "x", None)]
    docs = spark.createDataFrame([(*r, 0.5, "q") for r in rows], "doc_id long, text string, lang string, score double, lang_pred string")
    model = langid.train(docs)
    got = langid.predicted(docs, model).collect()
    assert len(got) == len(rows)
    assert all((r.lang_pred == "und") == (r.doc_id in (2, 3)) for r in got)
    kept = langid.keep_known(docs, model)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} <= {1, None, 4, 5}
    empty = langid.train(docs.limit(0))
    assert {r.lang_pred for r in langid.predicted(docs, empty).collect()} == {"und"}
    assert langid.predicted(docs.limit(0), model).count() == 0


def test_sample_is_bounded(spark):
    docs = spark.range(3000).selectExpr("id AS doc_id", "concat('the and of ', id) AS text", "if(id % 100 = 0, 'fr', 'en') AS lang")
    seen = []
    original, langid.fit = langid.fit, lambda labels, vectors: seen.extend(labels)
    try:
        langid.train(docs, sample_rows=100)
    finally:
        langid.fit = original
    assert 40 <= len(seen) <= 200 and 15 <= seen.count("fr") <= 30
