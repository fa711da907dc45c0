"""The corpus queries and the pipeline over the smallest test tables."""

import os

import compare
import corpus_pipeline
import plain
import pytest

from setwise.llm.common import load
from setwise.llm.oracles import ORACLES
from setwise.llm.queries import QUERIES

DATA = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="test tables are not here")


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, name):
    assert compare.difference(spark, compare.connect(DATA), name, DATA) is None


def test_held_out_documents_are_told_right(spark):
    told = QUERIES["op3_language_id"](spark, DATA).where("held_out").select("doc_id", "lang_pred")
    known = told.join(load(spark, DATA, "documents").select("doc_id", "lang"), "doc_id")
    assert known.where("lang_pred = lang").count() >= 0.98 * known.count() > 0


def test_good_documents_are_kept_and_junk_goes(spark):
    judged = QUERIES["op4_quality_rules"](spark, DATA).drop("quality").join(load(spark, DATA, "labels"), "doc_id")
    good, junk = judged.where("quality = 1 AND NOT base_failed"), judged.where("quality = 0")
    assert good.where("kept").count() >= 0.98 * good.count() > 0
    assert junk.where("NOT kept").count() >= 0.8 * junk.count() > 0


def test_token_queries_and_lines(spark):
    import sentencepiece

    docs = [tuple(r) for r in load(spark, DATA, "documents").select("doc_id", "text").collect()]
    model = sentencepiece.SentencePieceProcessor(model_file=__import__("public_tokenizers").path("piece_bpe_32k.model"))
    want = [(k, len(t.encode()), n := len(model.encode(t)), n > 4096) for k, t in docs]
    assert plain.ordered(QUERIES["op5_token_counts"](spark, DATA).collect()) == plain.ordered(want)
    lines = [(k, n, m, plain.sha(t)) for k, n, m, t in plain.without_repeated_lines(docs, 20)]
    assert plain.ordered(QUERIES["op1_line_dedup"](spark, DATA).collect()) == plain.ordered(lines)


def test_pipeline(spark, library):
    """Each stage against a plain version of it, on what the stage before kept."""
    docs = load(spark, DATA, "documents")
    rows = [tuple(r) for r in docs.collect()]
    stages = dict(corpus_pipeline.STAGES)
    told = stages["language ID"](spark, docs, DATA)
    assert told.columns == docs.columns and plain.ordered(told.collect()) == plain.ordered(rows)  # all have letters
    kept = stages["exact dedup"](spark, told, DATA)
    last = {}
    for r in rows:
        last[r[1]] = max(last.get(r[1], r), r)
    assert plain.ordered(kept.collect()) == plain.ordered(last.values())
    near = stages["near duplicates"](spark, kept, DATA)
    groups = {k: c for k, _, c in plain.near_duplicates([r[:2] for r in last.values()])}
    want = [r for r in last.values() if groups[r[0]] == r[0]]
    assert near.columns == docs.columns and plain.ordered(near.collect()) == plain.ordered(want)
    mixed = stages["mixing sources"](spark, near, DATA)
    assert mixed.columns == docs.columns and set(map(tuple, mixed.collect())) <= set(want)
    total, taken = (sum(len(plain.words(r["text"])) for r in t.collect()) for t in (near, mixed))
    assert 0.9 * total < taken < 1.1 * total
    out = stages["BPE encoding"](spark, mixed, DATA).collect()

    def encoded(text):
        ids = library.encode(text, add_special_tokens=False).ids
        return len(ids), plain.sha(" ".join(map(str, ids))), plain.sha(library.decode(ids, skip_special_tokens=False))

    assert plain.ordered(out) == plain.ordered((r["doc_id"], *encoded(r["text"])) for r in mixed.collect())


@pytest.fixture(scope="module")
def library():
    import public_tokenizers
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
