"""Mixing, language, quality, tokens and archives against plain versions and libraries."""

import random
from collections import defaultdict

import numpy as np
import plain
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from setwise.llm import bpe, language, mixing, quality, token_counts, warc
from setwise.llm.queries import vocabulary


# --- mixing -------------------------------------------------------------------------


def test_targets_fill_up_and_share_the_rest(spark):
    sizes = {"a": 100, "b": 10, "c": 1, "d": 0, None: 500, "e": 40}
    order = sorted(filter(None, sizes)) + [None]
    weights = dict(zip(order, [1, 2, 3, 1, 2, 3]))
    rows = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    told = mixing.rotating_weights(rows.select("source"))
    assert dict(told.collect()) == weights
    got = {r["source"]: r["target"] for r in mixing.source_targets(rows, told).collect()}
    assert got == pytest.approx(plain.targets(sizes, weights))
    some = mixing.source_targets(rows, told, budget=60.0)
    assert sum(r["target"] for r in some.collect()) == pytest.approx(60)


def test_mix_takes_epochs_first_and_ends_near_the_target(docs, messy):
    rows = mixing.mix(docs, seed=3).collect()
    assert sorted(r["size"] for r in rows) == sorted(len(plain.words(t)) for _, t in messy)
    by_source = defaultdict(list)
    for r in rows:
        by_source[r["source"]].append(r)
    sizes = {s: sum(r["size"] for r in own) for s, own in by_source.items()}
    order = sorted(filter(None, sizes)) + [None]
    targets = plain.targets(sizes, dict(zip(order, [1, 2, 3] * len(order))))
    for source, own in by_source.items():
        assert {r["source_size"] for r in own} == {sizes[source]}
        assert own[0]["target"] == pytest.approx(targets[source])
        taken, epochs = sum(r["taken"] for r in own), int(targets[source] // sizes[source])
        assert abs(taken - targets[source]) <= max(r["size"] for r in own) * 2  # one id may be there twice
        assert {r["copies"] for r in own} <= {epochs, epochs + 1} and all(r["taken"] <= 3 * r["size"] for r in own)
    assert plain.ordered(mixing.mix(docs.repartition(2), seed=3).collect()) == plain.ordered(rows)
    wide = mixing.mixed_documents(docs, seed=3)
    assert wide.columns == docs.columns
    assert wide.count() == sum(r["copies"] for r in rows)
    assert wide.where("score <> 8").isEmpty()


def test_heavier_documents_come_first_more_often(spark):
    sized = spark.range(4000).selectExpr("id key", "'s' source", "1L size", "IF(id % 2 = 0, 4.0D, 1.0D) weight")
    weights = spark.createDataFrame([("s", 1.0)], "source string, weight double")
    counts = mixing.mix_counts(sized, weights, budget=800.0).where("copies = 1").select((F.col("key") % 2).alias("odd"))
    n = {r["odd"]: r["count"] for r in counts.groupBy("odd").count().collect()}
    assert sum(n.values()) == 800 and 3 < n[0] / n[1] < 5


# --- language -----------------------------------------------------------------------


def test_grams_of_long_texts_are_those_of_the_whole(monkeypatch):
    whole = [np.sort(np.concatenate(list(language.grams(t)))) for t in ("", "ab", "Straße " * 50)]
    monkeypatch.setattr(language, "CHUNK_CELLS", 7)
    parts = [np.sort(np.concatenate(list(language.grams(t)))) for t in ("", "ab", "Straße " * 50)]
    assert all(np.array_equal(a, b) for a, b in zip(whole, parts))


def test_language_model_is_naive_bayes(spark):
    rows = [(0, "x", "aaa aaa"), (1, "x", "aab"), (2, "y", "bbb bbb"), (3, None, "ccc"), (4, "y", None)]
    model = language.train(spark.createDataFrame(rows, "doc_id long, lang string, text string"))
    assert model.languages == ["x", "y"] and np.exp(model.priors) == pytest.approx([2 / 3, 1 / 3])
    counts = np.full((language.BUCKETS, 2), language.SMOOTHING)
    for text, column in (("aaa aaa", 0), ("aab", 0), ("bbb bbb", 1)):
        for cells in language.grams(text):
            np.add.at(counts[:, column], cells, 1)
    logs = np.log(counts / counts.sum(axis=0))
    assert np.allclose(model.logs, logs, atol=1e-4)
    want = model.priors + sum(logs[c].sum(axis=0) for c in language.grams("aab bbb"))
    assert model.scores(["aab bbb"])[0] == pytest.approx(want, abs=1e-2)
    found, sure = model.predict(["aab", None, " 12 ", "bbb"])
    assert found == ["x", "und", "und", "y"] and sure[1] == sure[2] == 0 and sure[0] > 0.5


def test_languages_are_told_and_rows_kept_whole(docs, messy):
    rows = language.identify(docs).collect()
    assert len(rows) == len(messy) and {r["lang_pred"] for r in rows} == {"en", "und"}
    lettered = {i for i, (_, t) in enumerate(messy) if t and any(c.isalpha() for c in t)}
    assert sum(r["lang_pred"] == "en" for r in rows) == len(lettered)
    kept = language.in_a_known_language(docs)
    assert kept.columns == docs.columns and kept.count() == len(lettered)


# --- quality ------------------------------------------------------------------------


def test_measures(messy):
    m = quality.measures(pa.array([t for _, t in messy]))
    got = [tuple(int(m[c][i]) for c in quality.BASE) for i in range(len(messy))]
    assert got == [plain.measures(t) for _, t in messy]


def test_votes_are_weighed_by_estimated_accuracy():
    dice = np.random.default_rng(1)
    good = dice.random(20000) < 0.8
    accuracy = np.array([0.95, 0.9, 0.85, 0.6])
    right = dice.random((20000, 4)) < accuracy
    votes = np.where(right == good[:, None], 1, -1) * (dice.random((20000, 4)) < 0.8)
    codes, counts = np.unique((votes + 1) @ (3 ** np.arange(3, -1, -1)), return_counts=True)
    patterns = quality.pattern_votes(codes, 4)
    model = quality.estimate(patterns, counts)
    assert model.prior == pytest.approx(0.8, abs=0.05)
    assert (model.on_good + model.on_bad) / 2 == pytest.approx(accuracy, abs=0.08)
    verdict = dict(zip(codes.tolist(), model.posterior(patterns) >= 0.5))
    own = np.array([verdict[c] for c in ((votes + 1) @ (3 ** np.arange(3, -1, -1))).tolist()])
    assert (own == good).mean() > 0.93


def test_judged_rows(docs, messy):
    rows = quality.judge(docs).collect()
    got = plain.ordered((r["doc_id"], *[r[c] for c in quality.BASE]) for r in rows)
    assert got == plain.ordered((k, *plain.measures(t)) for k, t in messy)
    for r in rows:
        assert r["base_failed"] == (r["n_words"] < 20 or 100 * r["n_repeat_words"] > 30 * r["n_words"])
        assert r["kept"] == (not r["base_failed"] and r["quality"] >= 0.5)


# --- tokens -------------------------------------------------------------------------

PIECES, WORDS = "piece_bpe_32k.model", "word_bpe_49k.json"


@pytest.fixture(scope="module")
def pieces():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=vocabulary(PIECES))


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(vocabulary(WORDS))


def strings(messy, n, seed):
    dice = random.Random(seed)
    letters = " ".join(t or "" for _, t in messy)[:4000] + "  ▁  \n\t é漢🙂　\x00<s></s><0x0A>'s 12"
    return ["".join(dice.choice(letters) for _ in range(dice.randrange(30))) for _ in range(n)]


def test_transducer_counts_like_the_library(messy, pieces):
    counter, dice = token_counts.Counter(token_counts.Pieces.from_model(vocabulary(PIECES))), random.Random(1)
    for text in strings(messy, 4000, 5):
        want, own = len(pieces.encode(text)), token_counts.plain(text)
        assert counter.finish(counter.chunk(own)) == want
        cuts = sorted(dice.randrange(len(own) + 1) for _ in range(3))
        chunks = [own[a:b] for a, b in zip([0, *cuts], [*cuts, len(own)])]
        assert counter.finish(counter.scan([counter.chunk(c) for c in chunks])) == want


def test_transducer_with_few_states(monkeypatch, messy, pieces):
    counter = token_counts.Counter(token_counts.Pieces.from_model(vocabulary(PIECES)))
    monkeypatch.setattr(token_counts, "MAX_STATES", 40)
    monkeypatch.setattr(token_counts, "MAX_WORDS", 10)
    for text in strings(messy, 300, 6):
        assert counter.finish(counter.chunk(token_counts.plain(text))) == len(pieces.encode(text))


@pytest.mark.parametrize("long", [1 << 16, 50])
def test_token_counts(docs, messy, pieces, long):
    got = token_counts.count_tokens(docs, vocabulary(PIECES), long).collect()
    want = [(k, len((t or "").encode()), len(pieces.encode(t or ""))) for k, t in messy]
    assert plain.ordered(got) == plain.ordered(want)


def encoded(library, text):
    ids = library.encode(text or "", add_special_tokens=False).ids
    return len(ids), " ".join(map(str, ids)), library.decode(ids, skip_special_tokens=False)


def test_encoder_gives_the_ids_of_the_library(messy, library):
    encoder = bpe.Encoder(bpe.WordVocabulary(vocabulary(WORDS)))
    for text in strings(messy, 4000, 8):
        assert encoder.text(text) == encoded(library, text)[1:]


def test_tree_concatenation_agrees_with_merging_at_once():
    words, dice = bpe.WordVocabulary(vocabulary(WORDS)), random.Random(4)
    for _ in range(300):
        run = "".join(dice.choice(["the", "ing", "a", "b", "aaa", "é", "th"]) for _ in range(dice.randrange(1, 120)))
        symbols = words.symbols(run)
        assert words.encode_run(symbols, leaf=dice.choice([1, 2, 3, 7, 30])) == words.encode_symbols(symbols)


@pytest.mark.parametrize("giant", [1 << 16, 100])
def test_ids_and_round_trip(docs, messy, library, giant):
    got = bpe.encode(docs, vocabulary(WORDS), giant=giant).collect()
    assert plain.ordered(got) == plain.ordered((k, *encoded(library, t)) for k, t in messy)


# --- archives -----------------------------------------------------------------------


def page_rows():
    big, other = "ä" * 700 + "\r\n\r\nWARC/1.1\r\n", "x" * 5000
    return [
        (1, "http://a/ b\n", big), (2, None, big), (9, "http://c", big), (3, "http://d", "small"), (4, "http://e", "small"),
        (5, "http://f", None), (6, "", ""), (7, "http://g", other), (None, "http://h", other), (8, "http://i", "\r\n\r\n" * 300),
    ]


def test_archives_round_trip(spark):
    pages = spark.createDataFrame([(*r, 1) for r in page_rows()], "page_id long, url string, html string, archive int").repartition(3)
    got = {r["page_id"]: r for r in warc.round_trip(pages).collect()}
    assert len(got) == len(page_rows())
    for page, _, html in page_rows():
        body = (html or "").encode()
        import hashlib

        assert (got[page]["payload_bytes"], got[page]["payload_digest"]) == (len(body), hashlib.sha1(body).hexdigest())
    assert {p: r["refers_to"] for p, r in got.items() if r["record_type"] == "revisit"} == {1: 9, 2: 9, None: 7}


@pytest.mark.parametrize("cells, most", [(warc.MAX_CELLS, "-1"), (64, "-1"), (256, "10485760")])
def test_filters_of_any_size_give_the_same_archives(spark, cells, most):
    """Many copies and many single pages, with filters that name nearly all pages by mistake,
    and joins that are not broadcast."""
    texts = {i: f"{i % 7}" * 1200 if i % 3 else f"page {i} " * (i % 400) for i in range(600)}
    pages = spark.createDataFrame([(i, None, t) for i, t in texts.items()] + [(4, "again", texts[4]), (598, "again", texts[598])], "page_id long, url string, html string")
    usual = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", most)
    try:
        got = [(r["page_id"], r["record_type"], r["refers_to"]) for r in warc.round_trip(pages.repartition(4), max_cells=cells).collect()]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", usual)
    last = {}
    for i, text in texts.items():
        last[text] = max(i, last.get(text, i))
    want = []
    for i in [*texts, 4, 598]:
        revisit = len(texts[i]) >= 1000 and last[texts[i]] != i
        want.append((i, "revisit", last[texts[i]]) if revisit else (i, "response", None))
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_selected_records_are_read_by_few_ranges(spark):
    from setwise.session import work_dir

    path = work_dir(spark, "warc")
    pages = spark.range(300).selectExpr("id page_id", "concat('http://x/', id) url", "repeat(id, 50) html").coalesce(2)
    warc.write_archives(pages, path)
    index = warc.archive_index(spark, path)
    assert index.count() == 300 and index.select("archive").distinct().count() == 2
    chosen = index.where("page_id BETWEEN 20 AND 40 OR page_id = 250")
    assert warc.coalesced_ranges(chosen, gap=4).count() == 2
    assert warc.coalesced_ranges(index, most=10_000).count() > warc.coalesced_ranges(index).count() == 2
    payloads = {r["page_id"]: r["payload"].decode() for r in warc.read_records(chosen, gap=4).collect()}
    assert payloads == {i: str(i) * 50 for i in [*range(20, 41), 250]}


# --- empty tables -------------------------------------------------------------------


def test_empty_tables(spark, nothing):
    assert mixing.mix(nothing).isEmpty() and mixing.mixed_documents(nothing).isEmpty()
    assert language.identify(nothing).isEmpty() and language.in_a_known_language(nothing).isEmpty()
    assert quality.judge(nothing).isEmpty()
    assert token_counts.count_tokens(nothing, vocabulary(PIECES)).isEmpty()
    assert bpe.encode(nothing, vocabulary(WORDS)).isEmpty()
    assert warc.round_trip(spark.createDataFrame([], "page_id long, url string, html string")).isEmpty()
