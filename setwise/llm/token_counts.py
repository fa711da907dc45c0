"""Token counts by a finite-state transducer compiled from a vocabulary of pieces.

The vocabulary merges neighbouring pieces by score. The token that ends the encoding of a
prefix is unique: of the pieces that end the prefix it is the one that fits the token before
it, where two tokens fit if encoding them together gives just these two. So the number of
tokens can be followed from character to character, and all that is to be remembered are the
places where a longer piece may have begun, with the token before each. That is a state of a
deterministic transducer; a transition emits how much the number of tokens changes by one
more character (it falls when pieces merge). States are compiled when they are first
reached, up to a bound, after which the table is dropped and compiled anew.

No piece goes on over a space that follows a word, so such a space leads back to one state. A
chunk of text is therefore a map of states with a simple form: the characters up to there, the
count of what lies between, and what follows from the last such space on. Two neighbouring
chunks compose to a chunk, which is associative, and a text is composed of its chunks by a
scan over pairs. Long texts are cut into rows first, so that their chunks are counted in
parallel; the words of a chunk are counted once for each different word.

Where a chunk has no such space for long, its long stretches get a map proper, from states
at the begin to the state at the end and the count. Only states that can occur there are
followed: those that the characters before the chunk lead to, from each place where a token
may begin. They mostly meet soon and go on as one. A chunk that is reached in yet another state
keeps its text and is counted when the chunks are composed, so counts are exact in any case.

Cases: null or empty text has no tokens. Characters outside the vocabulary count one token for
each byte. Rows are counted one by one, so repeated rows make no difference. An empty table
gives an empty result.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from setwise.llm.common import whole
from setwise.llm.merges import NEVER, merge
from setwise.llm.words import small_batches

SPACE = "▁"
MAX_STATES = 1 << 17
MAX_WORDS = 1 << 19
MAX_CHARACTERS = 1 << 23
MAX_LENGTH = 1 << 10
"""Words, and characters of words, that a worker remembers, and the longest word that it does."""
LONG = 1 << 16
"""Texts of more characters are cut into rows of so many."""
CONTEXT = 64
"""Characters before a chunk that tell the states it can begin in."""
STARTS = 16
"""Places among them where a token may begin; pieces of equal characters are no longer."""
MAPPED = 256
"""Stretches of fewer characters get no map of states: to count them later is as cheap."""
MEETING = 2048
"""Characters within which states mostly meet; others are followed to the end."""


class Pieces:
    """The mergeable pieces of a vocabulary with their ranks (better ones are smaller), and
    the two parts that the last merge of each piece joins."""

    def __init__(self, scores: dict[str, float]):
        self.ranks = {piece: -score for piece, score in scores.items()}
        self.parts: dict[str, tuple[str, str]] = {}
        for piece in self.ranks:
            if len(piece) > 1 and len(parts := self.encode(piece, last_merge=False)) == 2:
                self.parts[piece] = (parts[0], parts[1])
        # Only what the vocabulary itself encodes to one token can be a token.
        self.tokens = {p for p in self.ranks if len(p) == 1 or p in self.parts}
        for piece, both in self.parts.items():
            if any(len(part) > 1 and self.ranks[part] > self.ranks[piece] for part in both):
                raise ValueError(f"{piece!r} is merged before its parts; this vocabulary cannot be compiled")

    @classmethod
    def from_model(cls, path: str) -> Pieces:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        special = (model.is_control, model.is_unknown, model.is_byte, model.is_unused)
        ids = [i for i in range(model.get_piece_size()) if not any(f(i) for f in special)]
        return cls({model.id_to_piece(i): model.get_score(i) for i in ids})

    def encode(self, text: str, last_merge: bool = True) -> list[str]:
        """The tokens of ``text``; without the last merge, the two that would make it one."""
        ranks = self.ranks

        def rank(a: str, b: str) -> float:
            return ranks.get(a + b, NEVER) if last_merge or len(a) + len(b) < len(text) else NEVER

        return merge(list(text), rank)

    def fits(self, left: str, right: str) -> bool:
        """Whether encoding both together gives just these two tokens.

        The merges that made the two are undone, the latest first. If at any time the two
        ends that meet could have merged before the merge undone last, they would have.
        """
        ranks, parts = self.ranks, self.parts
        limit, right_last = NEVER, True
        while True:
            rank = ranks.get(left + right)
            # Among equal ranks the leftmost merges first, so a tie counts only against the right.
            if rank is not None and (rank < limit or (rank == limit and right_last)):
                return False
            left_parts, right_parts = parts.get(left), parts.get(right)
            if left_parts is None and right_parts is None:
                return True
            right_last = left_parts is None or (right_parts is not None and ranks[right] >= ranks[left])
            if right_last:
                limit, right = ranks[right], right_parts[0]
            else:
                limit, left = ranks[left], left_parts[1]


StateMap = dict[str, tuple[str, int]]
"""State at the begin to state at the end and number of tokens."""


class Transducer:
    """States reached so far, and their transitions: character to next state and change.

    A state is a tuple of places where a longer piece may have begun: the characters since,
    the count there relative to now, and either the token before or, once few pieces are left
    that begin with these characters, those of them that fit it. So states that go on in the
    same way are the same, whatever came before.
    """

    FEW = 12

    def __init__(self, pieces: Pieces):
        self.pieces = pieces
        longer: dict[str, list[str]] = {}
        for piece in sorted(pieces.tokens):  # so that all workers write a state alike
            for i in range(len(piece) + 1):
                longer.setdefault(piece[:i], []).append(piece)
        self.longer = {run: tuple(found) if len(found) <= self.FEW else None for run, found in longer.items()}
        self._reset()

    def _reset(self) -> None:
        self.states: list[tuple] = []
        self.steps: list[dict[str, tuple[int, int]]] = []
        self.names: dict[tuple, int] = {}
        self.known: dict[tuple[str, str], tuple[str, ...]] = {}
        self._state((("", 0, ""),))

    def _state(self, places: tuple) -> int:
        name = self.names.get(places)
        if name is None:
            name = self.names[places] = len(self.states)
            self.states.append(places)
            self.steps.append({})
        return name

    def _fitting(self, before: str, run: str, pieces: tuple[str, ...]) -> tuple[str, ...]:
        """Those of ``pieces``, all that begin with ``run``, that fit ``before``."""
        if not before:
            return pieces
        found = self.known.get((before, run))
        if found is None:
            found = self.known[before, run] = tuple(p for p in pieces if self.pieces.fits(before, p))
        return found

    def _compile(self, state: int, character: str) -> tuple[int, int]:
        if character not in self.pieces.ranks:
            step = (0, len(character.encode()))  # nothing merges with it
        else:
            ends, open_places = None, []
            for run, count, left in self.states[state]:
                run += character
                if run not in self.longer:
                    continue
                if isinstance(left, str) and (pieces := self.longer[run]) is not None:
                    left = self._fitting(left, run, pieces)
                elif not isinstance(left, str):
                    left = tuple(p for p in left if p.startswith(run))
                # The one piece that fits the token before it ends the encoding so far.
                if ends is None and run in self.pieces.tokens:
                    if (run in left) if isinstance(left, tuple) else not left or self.pieces.fits(left, run):
                        ends = run, count + 1
                if isinstance(left, str) or any(len(p) > len(run) for p in left):
                    open_places.append((run, count, left))
            token, change = ends
            places = tuple((run, count - change, left) for run, count, left in open_places)
            step = (self._state((*places, ("", 0, token))), change)
        self.steps[state][character] = step
        return step

    def follow(self, state: int, run: str) -> tuple[int, int]:
        """The state that a run of characters leads to, and its tokens."""
        total = 0
        for character in run:
            if len(self.states) > MAX_STATES:
                places = self.states[state]
                self._reset()
                state = self._state(places)
            state, change = self.steps[state].get(character) or self._compile(state, character)
            total += change
        return state, total

    def count(self, run: str) -> int:
        """Tokens of a run of characters, from the first state on."""
        return self.follow(0, run)[1]

    def name(self, state: int) -> str:
        """What a state is, in a form that other workers read too."""
        return json.dumps(self.states[state], ensure_ascii=False)

    def named(self, name: str) -> int:
        found = ((run, count, tuple(left) if isinstance(left, list) else left) for run, count, left in json.loads(name))
        return self._state(tuple(found))

    def state_map(self, befores: list[str], run: str) -> StateMap:
        """From the states that each of ``befores`` leads to, to what ``run`` leads to."""
        known: StateMap = {}
        trail: list[tuple[str, int]] = []  # of the first state
        for before in befores:
            state = self.follow(0, before)[0]
            name = self.name(state)
            if name in known:
                continue
            own, total = [], 0
            for character in run[:MEETING]:
                state, change = self.follow(state, character)
                total += change
                own.append((self.name(state), total))
            met = next((i for i, (a, b) in enumerate(zip(own, trail)) if a[0] == b[0]), None)
            if met is None:
                state, more = self.follow(state, run[MEETING:])
                known[name] = self.name(state), total + more
            else:
                end, of_first = known[first]
                known[name] = end, of_first + own[met][1] - trail[met][1]
            if not trail:
                first, trail = name, own
        return known


Run = tuple[tuple[str, StateMap], ...]
"""Stretches of text, with what is known of them, and no space after a word in them all."""
Chunk = tuple[Run, int | None, Run]
"""Characters up to the first space after a word, the count from there to the last such
space, and the rest. Without such a space: all characters, None, nothing."""

_WORD_END = re.compile("(?<=[^ ]) ")


class Counter(dict):
    """Counts of words that follow one space, kept up to a bound."""

    def __init__(self, pieces: Pieces):
        super().__init__()
        self.machine = Transducer(pieces)
        self.held = 0

    def __missing__(self, word: str) -> int:
        found = self.machine.count(SPACE + word)
        if len(word) <= MAX_LENGTH:
            if len(self) >= MAX_WORDS or self.held > MAX_CHARACTERS:
                self.clear()
                self.held = 0
            self[word] = found
            self.held += len(word)
        return found

    def spaced(self, text: str) -> int:
        """Tokens of a text with one space added in front. Spaces in a row may merge, so they
        are counted with the word that follows."""
        words = text.split(" ")
        if "" not in words:
            return sum(map(self.__getitem__, words))
        total, spaces = 0, 1
        for word in words[:-1]:
            if word:
                total += self[word] if spaces == 1 else self.machine.count(SPACE * spaces + word)
                spaces = 0
            spaces += 1
        return total + self.machine.count(SPACE * spaces + words[-1])

    def chunk(self, text: str, context: str | None = None) -> Chunk:
        """``context`` are characters before the text; without it no states are mapped."""
        first = _WORD_END.search(text)
        if first is None:
            return self.run(text, context), None, ()
        bare = text.rstrip(" ")
        last = len(bare) if len(bare) < len(text) else len(text[: text.rindex(" ")].rstrip(" "))
        between = self.spaced(text[first.start() + 1 : last]) if last > first.start() else 0
        return self.run(text[: first.start()], context), between, self.run(text[last:], context and "")

    def run(self, text: str, context: str | None) -> Run:
        if context is None or len(text) < MAPPED:
            return ((text, {}),) if text else ()
        words = [m.start() for m in _WORD_END.finditer(context)]
        if not context or (text[0] == " " != context[-1]):
            befores = [""]  # a word begins with the text
        elif words:
            befores = [context[words[-1] :]]
        else:
            befores = [context[i:] for i in range(min(STARTS, len(context)))]
        befores = [b.replace(" ", SPACE) for b in befores]
        return ((text, self.machine.state_map(befores, text.replace(" ", SPACE))),)

    def measured(self, run: Run) -> int:
        """Tokens of a run that begins with a space."""
        state, total = 0, 0
        for text, known in run:
            found = known.get(self.machine.name(state)) if known else None
            if found is None:
                state, more = self.machine.follow(state, text.replace(" ", SPACE))
            else:
                state, more = self.machine.named(found[0]), found[1]
            total += more
        return total

    def compose(self, a: Chunk, b: Chunk) -> Chunk:
        x, y = a[0] if a[1] is None else a[2], b[0]
        if x and y and x[-1][0][-1] != " " == y[0][0][0]:  # a word ends where they meet
            left = (x, 0) if a[1] is None else (a[0], a[1] + self.measured(x))
            return (*left, y) if b[1] is None else (left[0], left[1] + self.measured(y) + b[1], b[2])
        if a[1] is None:
            return x + y, b[1], b[2]
        if b[1] is None:
            return a[0], a[1], x + y
        return a[0], a[1] + self.measured(x + y) + b[1], b[2]

    def scan(self, chunks: list[Chunk]) -> Chunk:
        """Compose neighbours, then neighbours of these, until one is left."""
        while len(chunks) > 1:
            chunks = [self.compose(*pair) if len(pair := chunks[i : i + 2]) > 1 else pair[0] for i in range(0, len(chunks), 2)]
        return chunks[0]

    def finish(self, chunk: Chunk) -> int:
        """Tokens of a whole text, which gets a space in front unless it is empty."""
        head, between, rest = chunk
        if not head:
            return 0
        return self.measured(((" ", {}), *head)) + (0 if between is None else between + self.measured(rest))

    def text(self, text: str) -> int:
        return self.spaced(text) if text else 0


@lru_cache(maxsize=4)
def _counter(path: str) -> Counter:
    """One for each worker process."""
    return Counter(Pieces.from_model(path))


def plain(text: str) -> str:
    """The character that stands for a space in the vocabulary is a space too."""
    return text.replace(SPACE, " ") if SPACE in text else text


RUN = pa.list_(pa.struct([("text", pa.string()), ("starts", pa.list_(pa.string())), ("ends", pa.list_(pa.string())), ("counts", pa.list_(pa.int64()))]))
RUN_SQL = "array<struct<text: string, starts: array<string>, ends: array<string>, counts: array<long>>>"


def _written(run: Run) -> list[dict]:
    return [
        {"text": text, "starts": list(known), "ends": [e for e, _ in known.values()], "counts": [n for _, n in known.values()]}
        for text, known in run
    ]


def _read(run: list[dict]) -> Run:
    return tuple((s["text"], dict(zip(s["starts"], zip(s["ends"], s["counts"])))) for s in run)


def chunk_maps(parts: DataFrame, path: str) -> DataFrame:
    """Rows of (row, part, before, text), the first ``before`` characters of a text being those
    before the chunk, to (row, part, head, between, rest)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(path)
        for batch in small_batches(batches, "text"):
            texts = zip(batch.column("before").to_pylist(), map(plain, batch.column("text").to_pylist()))
            heads, between, rests = zip(*[counter.chunk(t[n:], t[:n]) for n, t in texts])
            runs = [pa.array(list(map(_written, column)), RUN) for column in (heads, rests)]
            columns = [batch.column("row"), batch.column("part"), runs[0], pa.array(between, pa.int64()), runs[1]]
            yield pa.RecordBatch.from_arrays(columns, ["row", "part", "head", "between", "rest"])

    kind = parts.schema["row"].dataType.simpleString()
    return parts.mapInArrow(count, f"row {kind}, part int, head {RUN_SQL}, between long, rest {RUN_SQL}")


def _composed(df: DataFrame, path: str) -> DataFrame:
    """Rows of (doc_id, n_bytes, maps in order) to token counts."""

    def compose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(path)
        for batch in batches:
            n = []
            for i in range(batch.num_rows):  # the maps of one text at a time
                maps = batch.column("maps")[i].as_py()
                n.append(counter.finish(counter.scan([(_read(m["head"]), m["between"], _read(m["rest"])) for m in maps])))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("n_bytes"), pa.array(n, pa.int64())], ["doc_id", "n_bytes", "n_tokens"]
            )

    kind = dict(df.dtypes)["doc_id"]
    return df.mapInArrow(compose, f"doc_id {kind}, n_bytes long, n_tokens long")


def _counted(df: DataFrame, path: str) -> DataFrame:
    """Rows of (doc_id, n_bytes, text) to token counts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(path)
        for batch in small_batches(batches, "text"):
            n = [counter.text(plain(t)) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("n_bytes"), pa.array(n, pa.int64())], ["doc_id", "n_bytes", "n_tokens"]
            )

    return df.mapInArrow(count, f"doc_id {dict(df.dtypes)['doc_id']}, n_bytes long, n_tokens long")


def count_tokens(docs: DataFrame, path: str, long: int = LONG) -> DataFrame:
    """Per row of ``docs``: ``doc_id``, ``n_bytes`` and ``n_tokens`` with the model at ``path``.

    Texts up to ``long`` characters are counted where they are read. Longer ones are cut into
    rows, spread over the tasks, and only their maps come together again.
    """
    rows = docs.select("doc_id", F.octet_length(whole()).cast("long").alias("n_bytes"), whole().alias("text"))
    short = _counted(rows.where(F.length("text") <= long), path)
    cut = rows.where(F.length("text") > long).withColumns({"id": F.monotonically_increasing_id(), "padded": F.concat(F.lit(" "), "text")})
    row = F.struct("id", "doc_id", "n_bytes").alias("row")
    # With the space that a text gets in front, a chunk begins one character later.

    def part(i):
        before = F.least(F.lit(CONTEXT), F.lit(1) + i * F.lit(long))
        begin = F.lit(2) + i * F.lit(long) - before
        return F.struct(before.cast("int").alias("before"), F.col("padded").substr(begin, before + F.lit(long)).alias("text"))

    parts = F.transform(F.sequence(F.lit(0), F.expr(f"(length(text) - 1) div {long}").cast("int")), part)
    cut = cut.select(row, F.posexplode(parts).alias("part", "cut")).select("row", "part", "cut.before", "cut.text")
    maps = chunk_maps(cut.repartition("row", "part"), path)
    gathered = maps.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("part", "head", "between", "rest"))).alias("maps"))
    return short.unionByName(_composed(gathered.select("row.doc_id", "row.n_bytes", "maps"), path))
