"""Personal data by weak supervision.

Four kinds of spans: email, ip, card and phone. Exact patterns give the base spans, which
always stay. Wider patterns propose further candidates: addresses with ``(at)`` and
``(dot)``, IPv6 addresses, card numbers of other lengths or spellings, phone numbers without
a plus. Labelers look at every candidate, base or not, and say yes, no or nothing: the exact
pattern, arithmetic, gazetteers, the words before, the characters around, and the shape.
Nobody marked any span, so expectation-maximisation over the patterns of votes, counted over
all documents, estimates by kind how far each labeler can be trusted. The posteriors then
train a classifier (logistic regression) on votes, shape and words around; it decides on the
candidates that are no base spans.

Texts are read once; candidates are stored in a row per document. The counts are at most
``4 * 3 ** labelers`` rows, and the classifier is fitted on at most ``SAMPLE`` spans of each
such pattern, weighted by how many there are.

Patterns are searched from places where they must pass (an ``@``, a plus, a chain of digits),
so the time is linear in the text, however long its runs are.

Cases: a null or empty text has no spans. Rows are judged one by one, so repeated rows and
ids get equal results. Added spans overlap neither base spans nor each other: the more
probable goes first, then the earlier one. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import ipaddress
import re
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from setwise.llm.common import store
from setwise.llm.words import small_batches

KINDS = ("email", "ip", "card", "phone")
EMAIL, IP, CARD, PHONE = range(4)
SAMPLE = 200
"""Spans of one kind and pattern of votes that the classifier is fitted on."""
ACCEPT = 0.8
"""Probability from which on a candidate is a span."""
AROUND = 48
"""Characters before a candidate in which words are looked for."""
WORD_BUCKETS = 256

# Public lists that the gazetteers hold.
TOP_DOMAINS = frozenset("com org net edu gov mil int info biz name io co me de at ch fr be nl es pt it uk ie eu us ca au nz in jp cn kr br mx ru pl cz se no dk fi gr tr za".split())
CALLING_CODES = frozenset("1 7 20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61 62 63 64 65 66 81 82 84 86 90 91 92 93 94 95 98 212 213 216 218 351 352 353 354 355 356 357 358 359 370 371 372 373 380 381 385 386 420 421 852 886 971 972".split())
HINTS = (
    frozenset("email e-mail mail mailto contact write courriel correo kontakt".split()),
    frozenset("ip ipv4 ipv6 address host server client login adresse".split()),
    frozenset("card visa mastercard amex credit debit payment carte karte tarjeta".split()),
    frozenset("phone tel telephone call mobile cell fax téléphone telefon teléfono handy".split()),
)
OTHER_HINTS = frozenset(
    "isbn issn doi order invoice version release ref reference serial page pages section figure table article no nr id sku part build since from until date year".split()
)


class Span(NamedTuple):
    kind: int
    start: int
    end: int


_HOST = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_CHAIN = re.compile(r"[0-9]++(?:\.[0-9]++)*+")
_DIGITS = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_HAS_DIGIT = re.compile(r"[0-9]")
_NO_DIGIT = re.compile(r"[^0-9]+")


def digits_of(text: str) -> str:
    return _NO_DIGIT.sub("", text)


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        value = int(c) << (i & 1)
        total += value - 9 if value > 9 else value
    return total % 10 == 0


def small_part(part: str) -> bool:
    """Is the number at most 255? However many zeros lead it."""
    bare = part.lstrip("0")
    return len(bare) <= 3 and int(bare or "0") <= 255


def emails(text: str) -> Iterator[tuple[int, int]]:
    free, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        host = _HOST.match(text, at + 1) if start < at else None
        if host:
            free = host.end()
            yield start, free
        at = text.find("@", max(at + 1, free))


def addresses(text: str) -> Iterator[tuple[int, int]]:
    """Every four parts of a chain of numbers and dots, from its begin on."""
    for chain in _CHAIN.finditer(text):
        if text.find(".", *chain.span()) < 0:
            continue
        parts, at = chain.group().split("."), chain.start()
        for i in range(0, len(parts) - 3, 4):
            four = parts[i : i + 4]
            size = sum(map(len, four)) + 3
            if all(map(small_part, four)):
                yield at, at + size
            at += size + 1


def cards(text: str) -> Iterator[tuple[int, int]]:
    for found in _DIGITS.finditer(text):
        if found.end() - found.start() >= 16:
            digits = digits_of(found.group())
            if 16 <= len(digits) <= 19 and luhn(digits):
                yield found.span()


def phones(text: str) -> Iterator[tuple[int, int]]:
    for found in _PHONE.finditer(text):
        if 8 <= len(digits_of(found.group())) <= 15:
            yield found.span()


def base_spans(text: str) -> list[Span]:
    """In order of kind and start."""
    out = [Span(EMAIL, *s) for s in emails(text)] if "@" in text else []
    if _HAS_DIGIT.search(text):
        out += [Span(kind, *s) for kind, find in ((IP, addresses), (CARD, cards)) for s in find(text)]
        out += [Span(PHONE, *s) for s in phones(text)] if "+" in text else []
    return out


# --- Candidates ---------------------------------------------------------------------

_SPELLED_AT = re.compile(r"\x20?[(\[{]\x20?at\x20?[)\]}]\x20?", re.I)
_SPELLED_HOST = re.compile(r"[A-Za-z0-9-]{1,63}(?:(?:\.|\x20?[(\[{]\x20?dot\x20?[)\]}]\x20?)[A-Za-z0-9-]{1,63})+", re.I)
_SPELLED_DOT = re.compile(r"\x20?[(\[{]\x20?dot\x20?[)\]}]\x20?", re.I)
_IPV6 = re.compile(r"(?<![0-9A-Za-z:.])[0-9A-Fa-f]{0,4}(?::[0-9A-Fa-f]{0,4}){2,7}(?![0-9A-Za-z:.])")
_NUMBER = re.compile(r"\(?[0-9](?:(?:[\x20./-]|\)[\x20-]?|\x20?\()?[0-9])*+")


def _ipv6(text: str) -> ipaddress.IPv6Address | None:
    """The address, if it is one with three groups at least: most such runs are times."""
    try:
        return ipaddress.IPv6Address(text) if sum(map(bool, text.split(":"))) >= 3 else None
    except ValueError:
        return None


def candidates(text: str) -> Iterator[Span]:
    for at in _SPELLED_AT.finditer(text):
        start = at.start()
        while start > max(0, at.start() - 64) and text[start - 1] in _LOCAL:
            start -= 1
        host = _SPELLED_HOST.match(text, at.end())
        if host and start < at.start():
            yield Span(EMAIL, start, host.end())
    if not _HAS_DIGIT.search(text):
        return
    for found in _IPV6.finditer(text):
        if _ipv6(found.group()) is not None:
            yield Span(IP, *found.span())
    for found in _NUMBER.finditer(text):
        if 10 <= found.end() - found.start() <= 40:
            n = len(digits_of(found.group()))
            if 10 <= n <= 12 or n == 13 and found.group().startswith("00"):
                yield Span(PHONE, *found.span())
            elif 13 <= n <= 19:
                yield Span(CARD, *found.span())


# --- Labelers: 1 for yes, -1 for no, 0 for nothing ------------------------------------


class View(NamedTuple):
    """A candidate with what labelers look at."""

    kind: int
    base: bool
    text: str
    digits: str
    before: list[str]
    left: str
    right: str


_WORD = re.compile(r"[^\W_]+(?:-[^\W_]+)*")


def view(text: str, span: Span, base: bool) -> View:
    own = text[span.start : span.end]
    before = [w.lower() for w in _WORD.findall(text[max(0, span.start - AROUND) : span.start])[-5:]]
    return View(span.kind, base, own, digits_of(own), before, text[max(0, span.start - 1) : span.start], text[span.end : span.end + 1])


def _says(yes: bool) -> int:
    return 1 if yes else -1


def by_pattern(v: View) -> int:
    return 1 if v.base else 0


def by_arithmetic(v: View) -> int:
    if v.kind == CARD:
        return _says(luhn(v.digits))
    if v.kind == PHONE:
        return _says(len(set(v.digits)) > 2 and not v.digits.startswith("000"))
    if v.kind == IP and ":" in v.text:
        return _says(ipaddress.IPv6Address(v.text).is_global)
    if v.kind == IP:
        return _says(all(p == "0" or not p.startswith("0") for p in v.text.split(".")))
    labels = _SPELLED_DOT.sub(".", v.text).rsplit("@", 1)[-1].split(".")
    return _says(labels[-1].isalpha() and not any(x.startswith("-") or x.endswith("-") for x in labels))


def _issued(digits: str) -> bool:
    """Does a card issuer use numbers that begin so and are as long?"""
    n, two = len(digits), int(digits[:2])
    return (
        digits[0] == "4" and n in (13, 16, 19) or 51 <= two <= 55 and n == 16 or 2221 <= int(digits[:4]) <= 2720 and n == 16
        or two in (34, 37) and n == 15 or two in (36, 38, 39) and n == 14 or (two == 65 or digits[:4] == "6011") and 16 <= n <= 19
        or two == 35 and 16 <= n <= 19 or two == 62 and 16 <= n <= 19
    )


def by_gazetteer(v: View) -> int:
    if v.kind == CARD:
        return _says(_issued(v.digits))
    if v.kind == EMAIL:
        return _says(_SPELLED_DOT.sub(".", v.text).rsplit(".", 1)[-1].lower() in TOP_DOMAINS)
    if v.kind == IP:
        if ":" in v.text:
            return 0
        first = v.text.split(".")[0].lstrip("0")
        return _says(first not in ("", "127") and int(first) < 224)
    if v.text.startswith("+") or v.digits.startswith("00"):
        code = v.digits.removeprefix("00")
        return _says(any(code[:n] in CALLING_CODES for n in (1, 2, 3)))
    # Without a code: ten digits, area and exchange begin with 2 to 9.
    ten = v.digits[-10:]
    return _says(len(v.digits) - len(ten) <= 1 and ten[0] in "23456789" and ten[3] in "23456789")


def by_context(v: View) -> int:
    near = set(v.before)
    if near & HINTS[v.kind]:
        return 1
    return -1 if near & OTHER_HINTS or any(near & HINTS[k] for k in range(4) if k != v.kind) else 0


def by_surroundings(v: View) -> int:
    joined = v.left.isalnum() or v.right.isalnum()
    return _says(not (joined or v.left in "$€£#=_/\\.,-" and v.left or v.right in "%$€£_/\\@" and v.right))


_GROUPED = (
    None,
    None,
    re.compile(r"[0-9]{13,19}|[0-9]{4}(?:([ -])[0-9]{4})(?:\1[0-9]{4}){2}(?:\1[0-9]{1,3})?|[0-9]{4}([ -])[0-9]{6}\2[0-9]{4,5}"),
    re.compile(r"(?:\+?[0-9]{1,3}[ .-]?)?(?:\([0-9]{2,4}\)[ .-]?|[0-9]{2,4}[ .-])[0-9]{3,4}[ .-][0-9]{3,4}"),
)


def by_shape(v: View) -> int:
    if v.kind in (EMAIL, IP):
        return _says(len(v.text) <= 100) if v.kind == EMAIL else 0
    return _says(_GROUPED[v.kind].fullmatch(v.text) is not None)


LABELERS = (by_pattern, by_arithmetic, by_gazetteer, by_context, by_surroundings, by_shape)
N_VOTES = 3 * len(LABELERS)
LENGTHS = 16
N_FEATURES = len(KINDS) * (1 + N_VOTES + LENGTHS) + WORD_BUCKETS


def votes_of(v: View) -> list[int]:
    return [labeler(v) for labeler in LABELERS]


def pattern_of(votes: list[int]) -> int:
    code = 0
    for vote in votes:
        code = code * 3 + vote + 1
    return code


def votes_in(pattern: np.ndarray) -> np.ndarray:
    return pattern[:, None] // 3 ** np.arange(len(LABELERS) - 1, -1, -1) % 3 - 1


def features_of(v: View, votes: list[int]) -> list[int]:
    """Numbers of the features that hold: by kind its votes and length, and the last words
    before. The exact pattern's vote is left out: the classifier is for spans without it."""
    at = v.kind * (1 + N_VOTES + LENGTHS)
    out = [at, *[at + 1 + 3 * i + vote + 1 for i, vote in enumerate(votes) if LABELERS[i] is not by_pattern]]
    out.append(at + 1 + N_VOTES + min(LENGTHS - 1, len(v.text) // 3))
    words = {zlib.crc32(f"{v.kind} {w}".encode()) % WORD_BUCKETS for w in v.before[-2:]}
    return out + [len(KINDS) * (1 + N_VOTES + LENGTHS) + w for w in sorted(words)]


class Labeled(NamedTuple):
    kind: int
    start: int
    end: int
    base: bool
    pattern: int
    features: list[int]


def labeled(text: str) -> list[Labeled]:
    """All base spans, and the candidates that overlap none."""
    spans = base_spans(text)
    taken = sorted((s.start, s.end) for s in spans)
    starts = [s for s, _ in taken]
    reach, far = [], 0
    for _, end in taken:
        far = max(far, end)
        reach.append(far)
    every = [(s, True) for s in spans]
    for s in candidates(text):
        before = bisect_left(starts, s.end)  # base spans that begin before its end
        if not before or reach[before - 1] <= s.start:
            every.append((s, False))
    out = []
    for span, base in every:
        v = view(text, span, base)
        votes = votes_of(v)
        out.append(Labeled(*span, base, pattern_of(votes), features_of(v, votes)))
    return out


# --- Estimates and the classifier -----------------------------------------------------


class Reliability(NamedTuple):
    prior: float
    on_yes: np.ndarray
    on_no: np.ndarray

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        """Probability of a span, given its votes; those that say nothing do not count."""
        evidence = np.where(votes > 0, np.log(self.on_yes / (1 - self.on_no)), np.where(votes < 0, np.log((1 - self.on_yes) / self.on_no), 0.0))
        return 1 / (1 + np.exp(-np.log(self.prior / (1 - self.prior)) - evidence.sum(axis=1)))


BELIEF, BELIEF_ROWS = 0.8, 20.0
"""A labeler is taken to be right so often beforehand, which weighs as much as so many spans."""


def reliability(votes: np.ndarray, counts: np.ndarray, rounds: int = 200) -> Reliability:
    """Expectation-maximisation over patterns of votes and how often each occurs. Labelers
    stay better than chance, which keeps yes and no from changing places."""
    k = votes.shape[1]
    model = Reliability(0.5, np.full(k, BELIEF), np.full(k, BELIEF))
    for _ in range(rounds):
        yes = model.posterior(votes) * counts

        def right(mark: int, weight: np.ndarray) -> np.ndarray:
            agreed = (weight[:, None] * (votes == mark)).sum(axis=0)
            cast = (weight[:, None] * (votes != 0)).sum(axis=0)
            return np.clip((agreed + BELIEF * BELIEF_ROWS) / (cast + BELIEF_ROWS), 0.55, 0.995)

        prior = float(np.clip((yes.sum() + BELIEF_ROWS / 2) / (counts.sum() + BELIEF_ROWS), 0.02, 0.98))
        new = Reliability(prior, right(1, yes), right(-1, counts - yes))
        moved = max(abs(new.prior - model.prior), *np.abs(new.on_yes - model.on_yes), *np.abs(new.on_no - model.on_no))
        model = new
        if moved < 1e-7:
            break
    return model


def fit_classifier(features: list[list[int]], wanted: np.ndarray, weight: np.ndarray, decay: float = 1.0, rounds: int = 30) -> np.ndarray:
    """Weights of a logistic regression on features that hold or not, by Newton steps."""
    rows = np.repeat(np.arange(len(features)), [len(f) for f in features])
    flat = np.array([f for own in features for f in own], dtype=np.int64)
    used, column = np.unique(flat, return_inverse=True)
    x = np.zeros((len(features), len(used)), dtype=np.float32)
    x[rows, column] = 1
    b = np.zeros(len(used))
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-(x @ b)))
        slope = x.T @ (weight * (wanted - p)) - decay * b
        curve = (x * (weight * p * (1 - p))[:, None].astype(np.float32)).T @ x + decay * np.eye(len(used))
        step = np.linalg.solve(curve, slope)
        b = b + step * min(1.0, 4.0 / max(float(np.abs(step).max()), 1e-9))
        if np.abs(step).max() < 1e-8:
            break
    out = np.zeros(N_FEATURES)
    out[used] = b
    return out


class Model(NamedTuple):
    """``weights`` of the classifier and, for reports, the reliabilities by kind."""

    weights: np.ndarray
    reliabilities: dict[int, Reliability]

    def probability(self, features: list[int]) -> float:
        return float(1 / (1 + np.exp(-self.weights[features].sum())))


SPAN = "kind int, start int, end int, base boolean, pattern int, features array<int>"


def label(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``id`` and labeled ``spans`` of every document, stored."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("kind", pa.int32()), ("start", pa.int32()), ("end", pa.int32()), ("base", pa.bool_()), ("pattern", pa.int32()), ("features", pa.list_(pa.int32()))]))
        for batch in small_batches(batches, "text"):
            spans = [[s._asdict() for s in labeled(t)] if t else [] for t in batch.column("text").to_pylist()]
            yield pa.record_batch([batch.column("id"), pa.array(spans, kind)], ["id", "spans"])

    rows = docs.select(docs[key].alias("id"), docs[text].alias("text"))
    return store(rows.mapInArrow(find, f"id {dict(rows.dtypes)['id']}, spans array<struct<{SPAN.replace(' ', ':').replace(',:', ',')}>>"), "spans")


def train(found: DataFrame, sample: int = SAMPLE) -> Model:
    """Reliabilities from the counts of all votes, and the classifier from a bounded sample."""
    spans = found.select("id", F.explode("spans").alias("s")).select("id", "s.*")
    counts = spans.groupBy("kind", "pattern").count().toArrow().to_pandas()
    models, posteriors, times = {}, {}, {}
    for kind, own in counts.sort_values(["kind", "pattern"]).groupby("kind"):
        votes, n = votes_in(own["pattern"].to_numpy()), own["count"].to_numpy()
        models[int(kind)] = reliability(votes, n)
        for pattern, p, times_ in zip(own["pattern"], models[int(kind)].posterior(votes), n):
            posteriors[kind, pattern], times[kind, pattern] = p, times_
    mark = F.xxhash64("id", "start", "end", "features")
    place = F.row_number().over(Window.partitionBy("kind", "pattern").orderBy(mark, "features"))
    rows = spans.withColumn("place", place).where(F.col("place") <= sample).select("kind", "pattern", "features", "place").collect()
    rows.sort()
    if not rows:
        return Model(np.zeros(N_FEATURES), models)
    strata = [(r["kind"], r["pattern"]) for r in rows]
    weight = np.array([times[s] / min(times[s], sample) for s in strata])
    # Spans of all kinds and patterns together count as much as the sample has rows.
    weight = weight * len(rows) / weight.sum()
    return Model(fit_classifier([list(r["features"]) for r in rows], np.array([posteriors[s] for s in strata]), weight), models)


def chosen(spans: list[dict], model: Model, least: float = ACCEPT) -> list[Span]:
    """Base spans and accepted candidates without overlaps, in order of kind and start."""
    out = [Span(s["kind"], s["start"], s["end"]) for s in spans if s["base"]]
    rest = sorted((-p, s["start"], s["end"], s["kind"]) for s in spans if not s["base"] and (p := model.probability(s["features"])) >= least)
    taken: list[tuple[int, int]] = []
    for _, start, end, kind in rest:
        i = bisect_left(taken, (start, end))
        if (not i or taken[i - 1][1] <= start) and (i == len(taken) or end <= taken[i][0]):
            insort(taken, (start, end))
            out.append(Span(kind, start, end))
    return sorted(out)


def shown(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[s.kind]}:{s.start}:{s.end}" for s in sorted(spans))


def find_spans(docs: DataFrame, key: str = "doc_id", text: str = "text", sample: int = SAMPLE, least: float = ACCEPT) -> DataFrame:
    """Per row of ``docs``: its id, the number of base spans of each kind, ``base`` and
    ``spans`` as ``kind:start:end`` in order (code points, end exclusive), and ``n_added``."""
    found = label(docs, key, text)
    model = found.sparkSession.sparkContext.broadcast(train(found, sample))
    kind = dict(found.dtypes)["id"]

    def decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            base, every = [], []
            for spans in batch.column("spans").to_pylist():
                base.append([Span(s["kind"], s["start"], s["end"]) for s in spans if s["base"]])
                every.append(chosen(spans, model.value, least) if len(base[-1]) < len(spans) else base[-1])
            counts = [pa.array([sum(s.kind == k for s in own) for own in base], pa.int64()) for k in range(len(KINDS))]
            added = pa.array([len(e) - len(b) for b, e in zip(base, every)], pa.int64())
            yield pa.record_batch(
                [batch.column("id"), *counts, pa.array(map(shown, base), pa.string()), pa.array(map(shown, every), pa.string()), added],
                ["id", *[f"n_{k}" for k in KINDS], "base", "spans", "n_added"],
            )

    counts = ", ".join(f"n_{k} long" for k in KINDS)
    return found.mapInArrow(decide, f"id {kind}, {counts}, base string, spans string, n_added long").withColumnRenamed("id", key)
