"""A language of few rows is learned beside one of very many."""

import numpy as np
import pytest

from setwise.llm import language


def test_a_rare_language_is_learned(spark):
    rows = [(i, "many", f"abc abd {i % 7}") for i in range(9000)] + [(None, "few", f"xyz xyw {i}") for i in range(6)]
    model = language.train(spark.createDataFrame(rows, "doc_id long, lang string, text string"), most=100)
    assert model.languages == ["few", "many"]
    assert np.exp(model.priors) == pytest.approx([6 / 9006, 9000 / 9006])
    counts = np.full(language.BUCKETS, language.SMOOTHING)
    for _, lang, text in rows:
        if lang == "few":
            for cells in language.grams(text):
                np.add.at(counts, cells, 1)
    assert model.logs[:, 0] == pytest.approx(np.log(counts / counts.sum()), rel=1e-5)
    assert model.predict(["xyz xyw", "abc abd"])[0] == ["few", "many"]


def test_quota():
    assert language.quota([5, 40, 1000, 2000], 245) == 100
    assert language.quota([5, 40], 45) == float("inf")
    assert language.quota([1000] * 100, 100) == language.LEAST_OF_LANGUAGE


def test_very_many_languages_are_all_learned(spark, monkeypatch):
    """More than a full matrix would hold: they share fewer buckets."""
    monkeypatch.setattr(language, "MAX_CELLS", 1 << 18)
    words = [f"{chr(0x4E00 + 7 * i)}{chr(0x4E00 + 7 * i + 1)}" for i in range(600)]
    rows = [(i, f"l{i:03d}", f"{words[i]} {words[i]}") for i in range(600)] * 2
    model = language.train(spark.createDataFrame(rows, "doc_id long, lang string, text string"))
    assert len(model.languages) == 600 and model.logs.shape == (256, 600)
    found, _ = model.predict([f"{w} {w}" for w in words])
    assert sum(f == f"l{i:03d}" for i, f in enumerate(found)) >= 540


def test_only_letters_have_a_language():
    model = language.LanguageModel(["en"], np.zeros((language.BUCKETS, 1), dtype=np.float32), np.zeros(1))
    assert model.predict(["½ ²", "Ⅷ ①", "١٢", "_ - 5", "", None])[0] == ["und"] * 6
    assert model.predict(["a", "é", "漢", "ª", "1x"])[0] == ["en"] * 5


def test_only_texts_and_predictions_pass_between_spark_and_python(spark, monkeypatch):
    rows = [(i, text, lang, "s" * 9) for i in range(40) for text, lang in (("abc abd", "x"), ("xyz xyw", "y"), (None, "x"), ("1 2", None))]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")

    def refuse(*_):
        raise AssertionError("rows of a list go through Python workers of another kind")

    monkeypatch.setattr(type(spark.sparkContext), "parallelize", refuse)
    for told in (language.in_a_known_language(docs), language.identify(docs)):
        plan = told._jdf.queryExecution().executedPlan().toString()
        calls = [line for line in plan.splitlines() if "score(" in line and "EvalPython" in line]
        assert "MapInArrow" not in plan and len(calls) == 1
        assert calls[0].count("score(") == 1
    kept = language.in_a_known_language(docs)
    assert kept.schema == docs.schema
    assert sorted(map(tuple, kept.collect())) == sorted(r for r in rows if r[1] in ("abc abd", "xyz xyw"))
    told = {(r["doc_id"], r["lang_pred"]) for r in language.identify(docs).where("lang_pred <> 'und'").collect()}
    assert told == {(i, lang) for i in range(40) for lang in "xy"}
