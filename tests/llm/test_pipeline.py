import pytest

import corpus_pipeline
from pagemart.llm.langid import train
from pagemart.llm.quality import Rules, measure
from tests.llm.test_linededup import plain as plain_lines
from tests.llm.test_nearcopies import kept_ids
from tests.llm.test_packing import check

SF = "/root/testdata/sf0.001"


def test_stages_against_plain_python(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = docs.collect()
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality_rules", "language_id", "line_dedup", "near_dedup", "packing"]

    kept = stages["quality_rules"](spark, docs, SF)
    assert kept.schema == docs.schema
    wanted = [r for r in rows if measure(r.text, Rules())[-1]]
    assert 0 < len(wanted) < len(rows) and sorted(kept.collect()) == sorted(wanted)

    model = train(kept)
    known = stages["language_id"](spark, kept, SF)
    rows = [r for r in wanted if model.predict(r.text)[0] != "und" and model.predict(r.text)[1] >= 0.3]
    assert sorted(known.collect()) == sorted(rows)

    lines = stages["line_dedup"](spark, known, SF)
    assert lines.columns == docs.columns
    texts = {d: t for d, _, _, t in plain_lines([(r.doc_id, r.text) for r in rows])}
    assert {r.doc_id: (r.text, r.n_chars) for r in lines.collect()} == {d: (t, len(t)) for d, t in texts.items()}

    single = stages["near_dedup"](spark, lines, SF)
    named = kept_ids(list(texts.items()))
    assert {r.doc_id for r in single.collect()} == named and single.columns == docs.columns

    packed = stages["packing"](spark, single, SF).collect()
    check(packed, [(d, t) for d, t in texts.items() if d in named], 2048)
    assert sorted(map(tuple, corpus_pipeline.run(spark, SF).collect())) == sorted(map(tuple, packed))


def test_odd_rows_pass_through_all_stages(spark):
    words = " ".join(f"word{i}" for i in range(70))
    rows = [(1, words, "en", "s", 9), (2, words, "en", None, None), (3, None, None, None, None), (None, words + " more", None, "x", 1), (4, "", "en", "s", 0), (2, words, "en", None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF)
        assert [f.name for f in docs.schema] == ["doc_id", "text", "lang", "source", "n_chars"], name
    assert [r.doc_id for r in docs.collect()] == [1]
    assert corpus_pipeline.packing(spark, docs, SF).count() == 1


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_empty_table(spark, name):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    assert dict(corpus_pipeline.STAGES)[name](spark, docs, SF).count() == 0
