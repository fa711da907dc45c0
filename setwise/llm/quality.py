"""Quality by weak supervision: rules vote or abstain, and how far each can be trusted is
estimated from how they agree, without labels.

Every text is measured once. Each rule turns measures into a vote: good, bad or none. The
distinct patterns of votes are counted in Spark (at most 3 to the number of rules), and
expectation-maximisation over the pattern counts estimates, for each rule, how often it
votes good on good documents and bad on bad ones. The posterior probability that a document
is good, given all its votes, decides.

Cases: a null text has no words and fails the base test. Rows are judged one by one, so
repeated rows and ids get equal verdicts. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from setwise.llm.common import store
from setwise.llm.words import Words, constants, hash_ranges, mix, small_batches, sums_by_text

WINDOW = 8
SYMBOLS = "#*$%&|<>"
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
EXTRA = ("n_lines", "n_letters", "n_capitals", "n_exclaimed", "n_bare", "n_distinct")


def _marked(data: np.ndarray, characters: str) -> np.ndarray:
    table = np.zeros(256, dtype=bool)
    table[list(characters.encode())] = True
    return table[data]


def _lines(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begin, end and text of each line; a text ends its last line."""
    breaks = np.flatnonzero(data == 10)
    starts = np.sort(np.r_[offsets[:-1], breaks + 1], kind="stable")
    ends = np.sort(np.r_[offsets[1:], breaks], kind="stable")
    owner = np.searchsorted(offsets, starts, side="right") - 1
    # A line that begins where its text ends belongs to that text, not to the next one.
    owner = np.minimum(owner, np.searchsorted(offsets[1:], ends, side="left"))
    return starts, ends, owner


def _repeats(keys: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which keys occur twice or more for their owner, and which of them are not the first."""
    own = mix(keys ^ (owner.astype(np.uint64) * constants(1, 29)[0]))
    order = np.argsort(own, kind="stable")
    same = own[order][1:] == own[order][:-1]
    repeated, later = np.zeros(len(keys), dtype=bool), np.zeros(len(keys), dtype=bool)
    later[order[1:][same]] = True
    repeated[order[1:][same]] = True
    repeated[order[:-1][same]] = True
    return repeated, later


def measures(texts: pa.Array) -> dict[str, np.ndarray]:
    """Counts for each text of a batch. Null counts as empty."""
    words = Words(texts)
    data, offsets, n = words.data, words.offsets, len(words)
    owner = np.repeat(np.arange(n), words.counts())
    byte_sums = lambda mask: sums_by_text(mask, offsets)
    sizes = np.diff(np.r_[0, np.cumsum((data & 0xC0) != 0x80)][np.c_[words.starts, words.ends]], axis=1).ravel()

    starts, ends, line_owner = _lines(data, offsets)
    filled = np.searchsorted(words.starts, ends) > np.searchsorted(words.starts, starts)
    starts, ends, line_owner = starts[filled], ends[filled], line_owner[filled]
    _, later = _repeats(hash_ranges(data, starts, ends), line_owner)

    windows = words.windows(WINDOW, 8)
    inside = owner[: len(windows)] == owner[WINDOW - 1 :] if len(windows) else np.zeros(0, dtype=bool)
    at = np.flatnonzero(inside)
    repeated, _ = _repeats(windows[at], owner[at])
    edges = np.zeros(len(owner) + 1, dtype=np.int64)
    np.add.at(edges, at[repeated], 1)
    np.add.at(edges, at[repeated] + WINDOW, -1)
    covered = np.cumsum(edges[:-1]) > 0
    _, again = _repeats(words.hashes, owner)

    # Letters: A to Z in either case, and the first byte of every character beyond ASCII.
    letters = (((data | 32) >= 97) & ((data | 32) <= 122)) | (data >= 0xC0)
    lettered = np.r_[0, np.cumsum(letters)]

    return {
        "n_words": words.counts(),
        "word_chars": sums_by_text(sizes, words.first),
        "n_symbols": byte_sums(_marked(data, SYMBOLS)),
        "n_dup_lines": np.bincount(line_owner[later], minlength=n),
        "n_repeat_words": sums_by_text(covered, words.first),
        "n_lines": np.bincount(line_owner, minlength=n),
        "n_letters": byte_sums(letters),
        "n_capitals": byte_sums((data >= 65) & (data <= 90)),
        "n_exclaimed": byte_sums(data == 33),
        "n_bare": sums_by_text(lettered[words.ends] == lettered[words.starts], words.first),
        "n_distinct": words.counts() - sums_by_text(again, words.first),
    }


@dataclass(frozen=True)
class Rule:
    """Votes bad from ``bad`` on and good up to ``good`` (or the other way round if ``bad``
    is the smaller), and abstains between and where the rate is not defined."""

    name: str
    rate: Callable[[dict], np.ndarray]
    good: float
    bad: float

    def votes(self, m: dict[str, np.ndarray]) -> np.ndarray:
        with np.errstate(divide="ignore", invalid="ignore"):
            rate = self.rate(m)
        sign = 1 if self.bad > self.good else -1
        good, bad = rate * sign <= self.good * sign, rate * sign >= self.bad * sign
        return np.where(np.isnan(rate), 0, good.astype(np.int64) - bad.astype(np.int64))


RULES = (
    Rule("symbols by word", lambda m: m["n_symbols"] / m["n_words"], 0.02, 0.1),
    Rule("symbols by character", lambda m: m["n_symbols"] / m["word_chars"], 0.01, 0.05),
    Rule("other characters", lambda m: 1 - m["n_letters"] / m["word_chars"], 0.1, 0.2),
    Rule("words without letters", lambda m: m["n_bare"] / m["n_words"], 0.05, 0.2),
    Rule("capitals", lambda m: m["n_capitals"] / np.where(m["n_letters"] > 0, m["n_letters"], np.nan), 0.15, 0.4),
    Rule("exclamations", lambda m: m["n_exclaimed"] / m["n_words"], 0.02, 0.2),
    Rule("repeated text", lambda m: m["n_repeat_words"] / m["n_words"], 0.1, 0.3),
    Rule("repeated lines", lambda m: m["n_dup_lines"] / m["n_lines"], 0.25, 0.5),
    # Different words grow about as the root of the words, at any length.
    Rule("variety", lambda m: m["n_distinct"] / np.sqrt(m["n_words"]), 2.5, 1.5),
)


def pattern(m: dict[str, np.ndarray], rules=RULES) -> np.ndarray:
    """The votes of all rules as one number in base 3."""
    code = np.zeros(len(m["n_words"]), dtype=np.int64)
    for rule in rules:
        code = code * 3 + rule.votes(m) + 1
    return code


def pattern_votes(codes: np.ndarray, n_rules: int) -> np.ndarray:
    powers = 3 ** np.arange(n_rules - 1, -1, -1)
    return codes[:, None] // powers % 3 - 1


@dataclass(frozen=True)
class VoteModel:
    """Share of good documents, and by rule the accuracy of its votes on good and bad ones."""

    prior: float
    on_good: np.ndarray
    on_bad: np.ndarray

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        """Probability that a document with these votes is good; none of them counts twice."""
        evidence = np.where(
            votes > 0, np.log(self.on_good / (1 - self.on_bad)), np.where(votes < 0, np.log((1 - self.on_good) / self.on_bad), 0.0)
        )
        return 1 / (1 + np.exp(-np.log(self.prior / (1 - self.prior)) - evidence.sum(axis=1)))


PRIOR_ROWS = 20.0
"""Weight of what is believed beforehand, in documents: rules are mostly right."""


def estimate(votes: np.ndarray, counts: np.ndarray, rounds: int = 200) -> VoteModel:
    """Expectation-maximisation over patterns of votes and how often each occurs.

    The start and the weak prior say that a rule mostly votes good on good documents and is
    right on bad ones more often than not; accuracies stay above a half, which keeps the two
    classes from changing places.
    """
    k = votes.shape[1]
    model = VoteModel(0.85, np.full(k, 0.97), np.full(k, 0.6))
    for _ in range(rounds):
        good = model.posterior(votes) * counts
        bad = counts - good

        def share(mask, weight, belief):
            right = (weight[:, None] * (votes == mask)).sum(axis=0)
            cast = (weight[:, None] * (votes != 0)).sum(axis=0)
            return (right + belief * PRIOR_ROWS) / (cast + PRIOR_ROWS)

        new = VoteModel(
            float(np.clip((good.sum() + 0.85 * PRIOR_ROWS) / (counts.sum() + PRIOR_ROWS), 0.5, 0.99)),
            np.clip(share(1, good, 0.97), 0.55, 0.999),
            np.clip(share(-1, bad, 0.6), 0.1, 0.999),
        )
        moved = max(abs(new.prior - model.prior), *np.abs(new.on_good - model.on_good), *np.abs(new.on_bad - model.on_bad))
        model = new
        if moved < 1e-6:
            break
    return model


MEASURES = ", ".join(f"{c} long" for c in BASE) + ", pattern long"


def measure(docs: DataFrame, rules=RULES) -> DataFrame:
    """Per document its base measures and the pattern of its votes. One pass, no shuffle."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "text"):
            m = measures(batch.column("text"))
            columns = [pa.array(m[c].astype(np.int64)) for c in BASE] + [pa.array(pattern(m, rules))]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], ["doc_id", *BASE, "pattern"])

    rows = docs.select("doc_id", "text")
    return rows.mapInArrow(count, f"doc_id {dict(rows.dtypes)['doc_id']}, {MEASURES}")


def judge(docs: DataFrame, least: float = 0.5, rules=RULES) -> DataFrame:
    """Base measures, ``base_failed``, the posterior ``quality`` and ``kept`` per document."""
    rows = store(measure(docs, rules).withColumn("base_failed", F.expr("n_words < 20 OR 100 * n_repeat_words > 30 * n_words")), "measures")
    found = rows.groupBy("pattern").count().toArrow()
    codes, counts = found["pattern"].to_numpy(), found["count"].to_numpy()
    votes = pattern_votes(codes, len(rules))
    quality = estimate(votes, counts).posterior(votes) if len(codes) else np.zeros(0)
    verdicts = docs.sparkSession.createDataFrame(
        list(zip(codes.tolist(), quality.tolist())), "pattern long, quality double"
    )  # at most 3 ** len(rules) rows
    judged = rows.join(F.broadcast(verdicts), "pattern")
    kept = ~F.col("base_failed") & (F.col("quality") >= least)
    return judged.select("doc_id", *BASE, "base_failed", kept.alias("kept"), "quality")
