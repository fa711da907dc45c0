"""Language identification: multinomial naive Bayes over hashed character n-grams.

Training counts the n-grams of a bounded sample of labelled documents in Spark, drawn within
each language, so that a rare language is learned however many rows the others have. The matrix
of log-probabilities (languages by buckets) is broadcast, and batches of texts are scored as
sparse rows: the buckets of a text's n-grams point at rows of the matrix, which are summed
by text. A batch is worked through in chunks of bounded length, also within a long text.

Cases: null text, and text without a letter, is ``und`` with score 0. Null labels are not
learned from. If nothing can be learned every text is ``und``. Rows are predicted one by one,
so repeated ids and texts make no difference. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from setwise.llm.common import packed, unpacked
from setwise.llm.words import mix, small_batches

UNKNOWN = "und"
ORDERS = (2, 3)
BUCKETS = 1 << 16
SMOOTHING = 0.5
MAX_TRAINING_DOCUMENTS = 8000
"""Documents to learn from, about: all of the small languages, and as many of each other one,
by hash of the id and text."""
LEAST_OF_LANGUAGE = 30
"""Documents of a language that has so many, however small the sample."""
MAX_CELLS = 1 << 24
"""Cells of the matrix, 64 MB. Beyond 256 languages they share fewer buckets; all are learned."""
CHUNK_CELLS = 1 << 20

_PREDICTED = T.StructType([T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
_LETTER = regex.compile(r"\p{L}")


def bucket_count(languages: int) -> int:
    """A power of two: as many as ``BUCKETS``, or as fit ``MAX_CELLS``."""
    return min(BUCKETS, 1 << max(4, (MAX_CELLS // max(1, languages)).bit_length() - 1))


def grams(text: str, buckets: int = BUCKETS) -> Iterator[np.ndarray]:
    """Buckets of the n-grams of a text, chunk by chunk; chunks overlap by the longest order
    less one, so every n-gram occurs once."""
    codes = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    for order in ORDERS:
        for at in range(0, max(0, len(codes) - order + 1), CHUNK_CELLS):
            part = codes[at : at + CHUNK_CELLS + order - 1].astype(np.uint64)
            n = len(part) - order + 1
            key = np.full(n, order, dtype=np.uint64)
            for i in range(order):
                key = (key << np.uint64(21)) | part[i : i + n]
            yield (mix(key) % np.uint64(buckets)).astype(np.int64)


@dataclass(frozen=True)
class LanguageModel:
    """``logs[b, l]``: log-probability of bucket b in language l; ``priors[l]``."""

    languages: list[str]
    logs: np.ndarray
    priors: np.ndarray

    def scores(self, texts: list[str]) -> np.ndarray:
        """Log-likelihoods by text and language."""
        out = np.tile(self.priors, (len(texts), 1))
        most = max(1, CHUNK_CELLS // len(self.languages))
        held: list[np.ndarray] = []
        owner: list[int] = []
        size = 0

        def add() -> None:
            lengths = np.array([len(h) for h in held])
            sums = np.add.reduceat(self.logs[np.concatenate(held)], np.r_[0, np.cumsum(lengths)[:-1]], axis=0)
            np.add.at(out, owner, sums)
            held.clear()
            owner.clear()

        for i, text in enumerate(texts):
            for cells in grams(text, len(self.logs)):
                for at in range(0, len(cells), most):
                    held.append(cells[at : at + most])
                    owner.append(i)
                    size += len(held[-1])
                    if size >= most:
                        add()
                        size = 0
        if held:
            add()
        return out

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        """The likeliest language and its posterior probability."""
        known = [i for i, t in enumerate(texts) if t is not None and _LETTER.search(t)] if self.languages else []
        found, sure = [UNKNOWN] * len(texts), np.zeros(len(texts))
        if known:
            scores = self.scores([texts[i] for i in known])
            best = scores.argmax(axis=1)
            posterior = 1 / np.exp(scores - scores.max(axis=1, keepdims=True)).sum(axis=1)
            for i, language, p in zip(known, best, posterior):
                found[i], sure[i] = self.languages[language], p
        return found, sure


def _sample_counts(buckets: int):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Counts of (language, bucket) for all texts of a task: one row of counts for each
        language is held, as many cells as the matrix has."""
        counts: dict[str, np.ndarray] = {}
        for batch in small_batches(batches, "text"):
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
                own = counts.setdefault(lang, np.zeros(buckets, dtype=np.int64))
                for cells in grams(text, buckets):
                    own += np.bincount(cells, minlength=buckets)
        for lang, own in counts.items():
            full = np.flatnonzero(own)
            yield pa.record_batch([pa.array([lang] * len(full), pa.string()), pa.array(full.astype(np.int32)), pa.array(own[full])], ["lang", "bucket", "n"])

    return count


def quota(sizes: list[int], most: int) -> float:
    """How many documents to take of a language at most, so that there are ``most`` in all."""
    left = most
    for i, n in enumerate(sorted(sizes)):
        each = left / (len(sizes) - i)
        if n > each:
            return max(each, LEAST_OF_LANGUAGE)
        left -= n
    return float("inf")


def train(labelled: DataFrame, most: int = MAX_TRAINING_DOCUMENTS) -> LanguageModel:
    """Learn from ``labelled`` (doc_id, lang, text): from about ``most`` of its rows, chosen
    within each language by the hash of their id and text. A language's prior is its share of
    all labelled rows. Counts are summed in Spark; what reaches the driver is bounded by
    languages times buckets."""
    labelled = labelled.where("lang IS NOT NULL AND text IS NOT NULL")
    texts = {r["lang"]: r["n"] for r in labelled.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    languages = sorted(texts)
    buckets = bucket_count(len(languages))
    matrix = np.full((buckets, len(languages)), SMOOTHING)
    if not languages:
        return LanguageModel(languages, matrix.astype(np.float32), np.zeros(0))
    steps = 1 << 40
    each = quota(list(texts.values()), most)
    below = {lang: steps if n <= each else int(steps * each / n) for lang, n in texts.items()}
    # An Arrow table: a list of rows would go through Python workers of its own kind.
    limits = pa.table({"of": pa.array(languages, pa.string()), "below": pa.array([below[lang] for lang in languages], pa.int64())})
    limits = labelled.sparkSession.createDataFrame(limits)
    sample = labelled.join(F.broadcast(limits), F.col("lang") == F.col("of"))  # a row a language
    sample = sample.where(F.pmod(F.xxhash64(F.lit("sample"), "doc_id", "text"), F.lit(steps)) < F.col("below")).select("lang", "text")
    counts = sample.mapInArrow(_sample_counts(buckets), "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    found = counts.toArrow()
    place = {lang: i for i, lang in enumerate(languages)}
    column = np.array([place[lang] for lang in found["lang"].to_pylist()], dtype=np.int64)
    matrix[found["bucket"].to_numpy(), column] += found["n"].to_numpy()
    logs = np.log(matrix) - np.log(matrix.sum(axis=0))
    share = np.array([texts[lang] for lang in languages], dtype=float)
    return LanguageModel(languages, logs.astype(np.float32), np.log(share / share.sum()))


def predict(df: DataFrame, model: LanguageModel, text: str = "text") -> DataFrame:
    """Add ``lang_pred`` and ``score``. One pass over the rows, no shuffle. Only the text goes
    to Python, once, and only the prediction comes back."""
    shared = df.sparkSession.sparkContext.broadcast(model)

    def score(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        batches = (pa.RecordBatch.from_arrays([column], ["text"]) for column in columns)
        for batch in small_batches(batches, "text"):
            found, sure = shared.value.predict(batch.column("text").to_pylist())
            yield pa.StructArray.from_arrays([pa.array(found, pa.string()), pa.array(sure)], _PREDICTED.names)

    # Said to vary, so that a filter on the prediction is not worked out by predicting twice.
    told = F.arrow_udf(score, _PREDICTED).asNondeterministic()
    return df.withColumn("told", told(F.col(text))).select(*df.columns, "told.*")


def is_held_out(key: Column) -> Column:
    """Documents that are never learned from: a quarter, by checksum of the id."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def _model(docs: DataFrame, most: int) -> LanguageModel:
    return train(docs.where(~is_held_out(F.col("doc_id"))).select("doc_id", "lang", "text"), most)


def identify(docs: DataFrame, most: int = MAX_TRAINING_DOCUMENTS) -> DataFrame:
    """Learn from the labelled documents that are not held out, and predict all."""
    rows = docs.select("doc_id", is_held_out(F.col("doc_id")).alias("held_out"), "text")
    return predict(rows, _model(docs, most)).drop("text")


def in_a_known_language(docs: DataFrame, least: float = 0.5, most: int = MAX_TRAINING_DOCUMENTS) -> DataFrame:
    """The rows of ``docs`` whose language is known with a probability of ``least`` or more."""
    scored = predict(packed(docs, text=docs["text"]), _model(docs, most))
    return unpacked(scored.where((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= least)))
