"""Repeated lines against a plain version without a limit on the holders of a line."""

import random

import plain
import plain_lines

from setwise.llm import line_dedup


def text_of(name, n):
    return " ".join(f"{name}{i}" for i in range(n))


def removed(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    return {r["doc_id"]: r["n_removed"] for r in line_dedup.without_repeated_lines(docs).collect()}


def test_a_common_passage_of_one_line(spark):
    """More than RARE documents have it, each with other lines around."""
    notice = text_of("notice", 30)
    rows = [(i, "\n".join([text_of(f"a{i}_", 25), notice, text_of(f"b{i}_", 25)])) for i in range(60)]
    got = removed(spark, rows)
    assert got == plain_lines.removed(rows, plain.matched_lines)
    assert got == {i: int(i > 0) for i in range(60)}


def test_a_block_of_lines_first_held_apart(spark):
    a, b, x = text_of("a", 10), text_of("b", 10), text_of("x", 10)
    rows = [(1, f"{a}\n{x}\n{b}"), (2, f"{a}\n{b}"), (3, f"{a}\n{b}")]
    assert removed(spark, rows) == plain_lines.removed(rows, plain.matched_lines) == {1: 0, 2: 0, 3: 2}


def test_blocks_of_short_lines(spark):
    """Lines that all documents have in one order, so that only the pairing matters."""
    dice = random.Random(11)
    lines = [text_of(f"l{i}_", dice.choice([1, 2, 5, 9, 15, 22])) for i in range(40)]
    rows = [(i, "\n\n".join(x for x in lines if dice.random() < 0.75)) for i in range(120)]
    want = plain_lines.removed(rows, plain.matched_lines)
    assert 0 < sum(want.values()) and removed(spark, rows) == want


def test_a_passage_that_the_later_document_repeats(spark):
    p = "\n".join(text_of(f"p{i}_", 12) for i in range(3))
    u, v, x, y, z = (text_of(name, 15) for name in "uvxyz")
    rows = [(1, f"{u}\n{p}\n{v}"), (2, f"{x}\n{p}\n{y}\n{p}\n{z}"), (3, f"{p}\n{u}\n{p}\n{x}\n{p}")]
    want = plain_lines.removed(rows, lambda a, b: plain_lines.matched(a, b, lambda s: len(s.split())))
    assert removed(spark, rows) == want
    assert want[2] == 3


def test_blocks_in_gaps_without_anchors():
    dice = random.Random(4)
    more = 0
    for _ in range(1500):
        size = [dice.randint(1, 12) for _ in range(9)]
        a, b = ([dice.randrange(9) for _ in range(dice.randrange(22))] for _ in range(2))
        words = [size[x] for x in b]

        def long(blocks):
            return {(i, j, n) for i, j, n in blocks if sum(words[j : j + n]) >= 20}

        got = long(line_dedup.aligned(a, b, words, 20))
        assert got == long(plain_lines.blocks_of(plain_lines.matched(a, b, size.__getitem__)))
        more += len(got - long(line_dedup.patience(a, b)))
    assert more > 0


def test_a_block_that_only_a_later_holder_has_in_order(spark):
    a, b, x, y = text_of("a", 25), text_of("b", 30), text_of("x", 9), text_of("y", 9)
    rows = [(1, f"{a}\n{b}"), (2, f"{b}\n{x}\n{a}"), (3, f"{b}\n{y}\n{a}")]
    assert removed(spark, rows) == plain_lines.removed(rows, plain.matched_lines) == {1: 0, 2: 1, 3: 2}


def test_a_long_first_holder_of_a_line_that_very_many_have(spark):
    """Only the lines that others have too are sent along, once more for each partner."""
    notice = text_of("notice", 30)
    long = "\n".join([notice, *(text_of(f"own{i}_", 3) for i in range(20_000))])
    rows = [(0, long), *((i, f"{text_of(f'u{i}_', 4)}\n{notice}") for i in range(1, 2001))]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(8)
    found = line_dedup.without_repeated_lines(docs)
    assert {(r["n_removed"], r["n"]) for r in found.where("doc_id > 0").groupBy("n_removed").agg({"*": "count"}).toDF("n_removed", "n").collect()} == {(1, 2000)}
    shown = next(line_dedup._shared(iter([_row([1, 2, 3, 4, 5, 6, 7], [2, 5])])))
    assert shown.column("at").to_pylist() == [[0, 1, 2, 4, 5]] and shown.column("lines").to_pylist() == [[1, 2, 3, 5, 6]]


def _row(lines, others):
    import pyarrow as pa

    cells = {"doc_id": [1], "tie": [1], "lines": [lines], "words": [[1] * len(lines)], "others": [others]}
    return pa.RecordBatch.from_pydict(cells, pa.schema([("doc_id", pa.int64()), ("tie", pa.int64()), ("lines", pa.list_(pa.int64())), ("words", pa.list_(pa.int32())), ("others", pa.list_(pa.int64()))]))


def test_hashes_of_lines():
    import pyarrow as pa

    texts = ["a b\n\n c \nd", "", None, "\n\n", "x\ty\r\nd", "c", " d \x0b\n d"]
    hashes, counts, first = line_dedup._hash_lines(pa.array(texts))
    found = [list(zip(hashes[a:b].tolist(), counts[a:b].tolist())) for a, b in zip(first[:-1], first[1:])]
    assert [[n for _, n in own] for own in found] == [[2, 1, 1], [], [], [], [2, 1], [1], [1, 1]]
    d = found[0][2][0]
    assert found[4][1][0] == found[6][0][0] == found[6][1][0] == d and found[0][1][0] == found[5][0][0] != d
