"""Byte-pair encoding and decoding of texts with a word vocabulary, by tree concatenation.

A text is split into words and these into runs of letters, single digits and runs of other
characters; each run is encoded on its own, once for each different word of a batch of
texts. Words with characters newer than the tables here are normalised and split by the
tokenizer's own library. A run that nothing splits can be as long as the text. It is cut into pieces, the
pieces are encoded in parallel, and neighbours are joined in a tree: the tokens around the
join are encoded again, in windows that grow until the first and the last token of the
window agree with what both sides had. Every two neighbours are then encoded as they would be
together, which makes the whole the encoding of the run.

Pieces of a very long run are rows of their own and spread over the tasks.

Cases: null or empty text, and text of white space, has no tokens. Special tokens in a text
are recognised. Rows are encoded one by one, so repeated rows make no difference. An empty
table gives an empty result.
"""

from __future__ import annotations

import hashlib
import json
import re
import sys
import unicodedata
from collections.abc import Callable, Iterator
from functools import cached_property, lru_cache

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from setwise.llm.common import whole
from setwise.llm.merges import NEVER, merge
from setwise.llm.words import small_batches

LEAF = 256
"""Symbols up to which a run is encoded at once."""
GIANT = 1 << 16
"""Symbols from which on the pieces of a run are rows of their own."""
MAX_WORDS = 1 << 19
MAX_CHARACTERS = 1 << 23
"""Words, and characters of words, up to which a task remembers encodings."""
END = "</w>"

# The pattern that splits words, as the vocabulary file states it, and the
# white space of its normaliser.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
WHITE = (*range(9, 14), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)

_NOT_WHITE_HERE = re.compile("[" + "".join(map(chr, range(0x1C, 0x20))) + "]")  # str.split() takes these as white space
_WHITE = re.compile("[" + "".join(map(chr, WHITE)) + "]+")


def byte_letters() -> list[str]:
    """The printable character that stands for each byte: itself where it is printable and
    not a space, else the next free one from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    letters = {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}
    return [letters[b] for b in range(256)]


@lru_cache(maxsize=1)
def _settled() -> re.Pattern:
    """Characters that were letters, digits or signs already in the Unicode of 2002. On these
    Python, the splitting pattern and the library agree, whatever version each was made for;
    words with any other character are left to the library. The tests go through all."""
    kind = unicodedata.ucd_3_2_0.category
    known = [kind(chr(c)) not in ("Cn", "Cs", "Co") for c in range(sys.maxunicode + 1)]
    edges = [c for c in range(len(known)) if known[c] and not (c and known[c - 1])]
    ends = [c for c in range(len(known)) if known[c] and (c == sys.maxunicode or not known[c + 1])]
    return re.compile("[" + "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in zip(edges, ends)) + "]*+")


Joined = list[str]


class WordVocabulary:
    """Ids and merges of a vocabulary with word ends."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        self.ids: dict[str, int] = model["vocab"]
        self.ranks = {tuple(m if isinstance(m, list) else m.split(" ")): float(i) for i, m in enumerate(model["merges"])}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self._special = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")")
        self._split = regex.compile(SPLIT)
        self._letters = byte_letters()
        self._rules = json.dumps(spec | {"added_tokens": [], "model": {"type": "BPE", "vocab": {}, "merges": []}})

    @cached_property
    def _library(self):
        """The library's normaliser and splitter alone, loaded only if a text needs them."""
        from tokenizers import Tokenizer

        return Tokenizer.from_str(self._rules)

    def symbols(self, run: str) -> list[str]:
        """The bytes of a run as letters, the last one with the mark of the word's end."""
        letters = [self._letters[b] for b in run.encode("utf-8")]
        letters[-1] += END
        return letters

    def runs(self, word: str) -> list[str]:
        """A word without white space, normalised and split."""
        if not word.isascii():
            if not _settled().fullmatch(word):
                word = self._library.normalizer.normalize_str(word)
                return [word[a:b] for _, (a, b) in self._library.pre_tokenizer.pre_tokenize_str(word)]
            word = unicodedata.normalize("NFC", word)
        # Each character on its own: str.lower() would look at the neighbours of a sigma.
        word = "".join(c.lower() for c in word) if "Σ" in word else word.lower()
        return [word] if word.isalpha() else self._split.findall(word)

    def words(self, text: str) -> Iterator[str]:
        """Words and special tokens of a text, in order."""
        if "<|" not in text:
            yield from self._words(text)
            return
        for i, part in enumerate(self._special.split(text)):
            if i % 2:
                yield part
            else:
                yield from self._words(part)

    @staticmethod
    def _words(text: str) -> list[str]:
        return [w for w in _WHITE.split(text) if w] if _NOT_WHITE_HERE.search(text) else text.split()

    def encode_symbols(self, symbols: list[str]) -> Joined:
        ranks = self.ranks
        return merge(symbols, lambda a, b: ranks.get((a, b), NEVER))

    def parts(self, token: str) -> list[str]:
        """The symbols of a token."""
        bare = token.removesuffix(END) if token != END else token
        letters = list(bare)
        if bare != token:
            letters[-1] += END
        return letters

    def join(self, left: Joined, right: Joined) -> Joined:
        """The encoding of two neighbouring texts put together."""
        size = 1
        while True:
            a, b = left[-size:], right[:size]
            window = self.encode_symbols([s for token in (*a, *b) for s in self.parts(token)])
            agree_left = len(a) == len(left) or window[0] == a[0]
            agree_right = len(b) == len(right) or window[-1] == b[-1]
            if agree_left and agree_right and (len(window) > 1 or (len(a) == len(left) and len(b) == len(right))):
                return left[: len(left) - len(a)] + window + right[len(b) :]
            size *= 2

    def join_all(self, pieces: list[Joined]) -> Joined:
        """Join neighbours, then neighbours of these, until one is left."""
        while len(pieces) > 1:
            pieces = [self.join(*pair) if len(pair := pieces[i : i + 2]) > 1 else pair[0] for i in range(0, len(pieces), 2)]
        return pieces[0]

    def encode_run(self, symbols: list[str], leaf: int = LEAF) -> Joined:
        return self.join_all([self.encode_symbols(symbols[i : i + leaf]) for i in range(0, len(symbols), leaf)])

    def encode_word(self, word: str) -> Joined:
        if word in self.special:
            return [word]
        return [token for run in self.runs(word) for token in self.encode_run(self.symbols(run))]

    def id_of(self, token: str) -> int:
        found = self.special.get(token)
        return self.ids[token] if found is None else found


class Encoder:
    """Ids and tokens of words as texts, kept up to a bound."""

    def __init__(self, vocabulary: WordVocabulary, most: int = MAX_WORDS):
        self.vocabulary = vocabulary
        self.most = most
        self.shown_ids = {t: str(vocabulary.id_of(t)) for t in [*vocabulary.ids, *vocabulary.special]}
        self.ids: dict[str, str] = {}
        self.tokens: dict[str, str] = {}
        self.again: set[str] = set()
        self.held = 0

    def _forget(self) -> None:
        """Keep the words that came again in a later text, unless these are too many."""
        kept = self.again if len(self.again) <= self.most // 2 else set()
        self.ids, self.tokens = ({word: known[word] for word in kept} for known in (self.ids, self.tokens))
        self.held = sum(map(len, kept))
        if self.held > MAX_CHARACTERS // 2:
            self.ids, self.tokens, self.held = {}, {}, 0
        self.again = set()

    def _learn(self, words: set[str]) -> None:
        for word in words:
            self.ids[word], self.tokens[word] = self.shown(self.vocabulary.encode_word(word))
            self.held += len(word)

    def shown(self, tokens: Joined) -> tuple[str, str]:
        """Decimal ids, and the decoded text: this vocabulary has no decoder, so decoding
        sets the tokens themselves side by side."""
        return " ".join(map(self.shown_ids.__getitem__, tokens)), " ".join(tokens)

    def text(self, text: str) -> tuple[str, str]:
        words = list(self.vocabulary.words(text))
        if len(self.ids) > self.most or self.held > MAX_CHARACTERS:
            self._forget()
        different = set(words)
        new = different.difference(self.ids)
        self._learn(new)
        self.again.update(different - new)
        ids, tokens = map(self.ids.__getitem__, words), map(self.tokens.__getitem__, words)
        return " ".join(filter(None, ids)), " ".join(filter(None, tokens))


@lru_cache(maxsize=4)
def _vocabulary(path: str) -> WordVocabulary:
    """One for each worker process."""
    return WordVocabulary(path)


def _encoder(path: str, most: int = MAX_WORDS) -> Encoder:
    """One for each task, so that what it remembers is given back."""
    return Encoder(_vocabulary(path), most)


def n_ids(ids: str) -> int:
    return ids.count(" ") + 1 if ids else 0


def _digest(text: str) -> str:
    return hashlib.sha256(text.encode("utf-8")).hexdigest()


FORMS: dict[str, tuple[str, Callable[[str], str]]] = {
    "texts": ("n_tokens long, ids string, decoded string", lambda text: text),
    "digests": ("n_tokens long, ids_sha256 string, decoded_sha256 string", _digest),
}


def _output(keys: pa.Array, both: list[tuple[str, str]], form: str) -> pa.RecordBatch:
    names = ["doc_id", *[c.split(" ")[0] for c in FORMS[form][0].split(", ")]]
    show = FORMS[form][1]
    columns = [keys, pa.array([n_ids(ids) for ids, _ in both], pa.int64())]
    columns += [pa.array([show(pair[i]) for pair in both], pa.string()) for i in range(2)]
    return pa.RecordBatch.from_arrays(columns, names)


def _cut(vocabulary: WordVocabulary, text: str, giant: int) -> Iterator[tuple[bool, int, str]]:
    """A text as parts in order: words to be encoded as they are, and pieces of giant runs,
    with the number of the run they belong to. Symbols of a piece are joined by spaces."""
    run_number, plain = 0, []
    for word in vocabulary.words(text):
        runs = [] if word in vocabulary.special or len(word) <= giant // 4 else vocabulary.runs(word)
        symbols = [vocabulary.symbols(run) for run in runs]
        if all(len(s) <= giant for s in symbols):
            plain.append(word)
            continue
        if plain:
            yield False, run_number, " ".join(plain)
            plain = []
        for own in symbols:
            run_number += 1
            for i in range(0, len(own), giant):
                yield True, run_number, " ".join(own[i : i + giant])
    if plain:
        yield False, run_number, " ".join(plain)


def _with_giants(rows: DataFrame, path: str, form: str, giant: int) -> DataFrame:
    """Texts with giant runs: cut them, encode the parts in parallel, and join them again."""
    kind = dict(rows.dtypes)["doc_id"]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = _vocabulary(path)
        for batch in small_batches(batches, "text"):
            for i, text in enumerate(batch.column("text").to_pylist()):
                parts = list(_cut(vocabulary, text, giant))
                pieces, runs, texts = zip(*parts) if parts else ((), (), ())
                n = len(parts)
                own = [pa.concat_arrays([batch.column(c).slice(i, 1)] * n) if n else batch.column(c).slice(0, 0) for c in ("row", "doc_id")]
                own += [pa.array(range(n), pa.int32()), pa.array(pieces, pa.bool_()), pa.array(runs, pa.int32()), pa.array(texts, pa.string())]
                yield pa.RecordBatch.from_arrays(own, ["row", "doc_id", "part", "piece", "run", "text"])

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(path)
        for batch in small_batches(batches, "text"):
            out = []
            for piece, text in zip(batch.column("piece").to_pylist(), batch.column("text").to_pylist()):
                out.append(" ".join(encoder.vocabulary.encode_run(text.split(" "))) if piece else encoder.text(text)[1])
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in ("row", "doc_id", "part", "piece", "run")], pa.array(out, pa.string())],
                ["row", "doc_id", "part", "piece", "run", "tokens"],
            )

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(path)
        for batch in batches:
            for row in range(batch.num_rows):  # one giant text at a time
                parts = batch.column("parts")[row].as_py()
                tokens: Joined = []
                i = 0
                while i < len(parts):
                    j = i + 1
                    while parts[i]["piece"] and j < len(parts) and parts[j]["piece"] and parts[j]["run"] == parts[i]["run"]:
                        j += 1
                    tokens += encoder.vocabulary.join_all([p["tokens"].split(" ") for p in parts[i:j]])
                    i = j
                yield _output(batch.column("doc_id").slice(row, 1), [encoder.shown(tokens)], form)

    columns = "part int, piece boolean, run int"
    parts = rows.withColumn("row", F.monotonically_increasing_id()).mapInArrow(cut, f"row long, doc_id {kind}, {columns}, text string")
    done = parts.repartition("row", "part").mapInArrow(encode, f"row long, doc_id {kind}, {columns}, tokens string")
    gathered = done.groupBy("row", "doc_id").agg(F.sort_array(F.collect_list(F.struct("part", "piece", "run", "tokens"))).alias("parts"))
    return gathered.select("doc_id", "parts").mapInArrow(join, f"doc_id {kind}, {FORMS[form][0]}")


def encode(docs: DataFrame, path: str, form: str = "texts", giant: int = GIANT, remember: int = MAX_WORDS) -> DataFrame:
    """Per row of ``docs``: ``doc_id``, ``n_tokens``, and the ids and the decoded text (or,
    as ``digests``, the SHA-256 of both) with the vocabulary file at ``path``. A task remembers
    the encodings of ``remember`` words: fewer take less memory and more time."""
    rows = docs.select("doc_id", whole().alias("text"))
    kind = dict(rows.dtypes)["doc_id"]
    # A byte makes a symbol, and a character has four bytes at most.
    holds_giant = (F.octet_length("text") > giant) & F.exists(F.split("text", r"\s+"), lambda w: F.length(w) > giant // 4)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(path, remember)
        for batch in small_batches(batches, "text"):
            both = [encoder.text(text) for text in batch.column("text").to_pylist()]
            yield _output(batch.column("doc_id"), both, form)

    usual = rows.where(~holds_giant).mapInArrow(run, f"doc_id {kind}, {FORMS[form][0]}")
    return usual.unionByName(_with_giants(rows.where(holds_giant), path, form, giant))
