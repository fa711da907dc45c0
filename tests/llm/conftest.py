import random

import pytest

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def messy():
    """Ids and texts with everything that can be odd about them."""
    dice = random.Random(7)
    vocabulary = [f"w{i}" for i in range(40)] + ["été", "Straße,", "漢字", "THE", "the."]
    passages = [" ".join(dice.choice(vocabulary) for _ in range(40)) for _ in range(4)]
    line = " ".join(dice.choice(vocabulary) for _ in range(12))
    rows = [
        (None, passages[0] + " x"), (1, None), (2, ""), (2, ""), (3, " \n\t "), (4, "a b c"), (5, "A b\nC"),
        (6, passages[1]), (7, passages[1]), (7, passages[1]), (8, "x" * 3000), (9, "one word " * 2000), (10, "\n".join([line] * 5)),
        (11, "#" * 50 + " $$ %%"), (12, "<|endoftext|> it's 12 ▁▁  double  spaces  "), (13, "Σ é́ \x00   \x85 \x1c."),
    ]
    for i in range(60):
        parts = [dice.choice([dice.choice(passages), line, dice.choice(vocabulary), dice.choice(passages)[7:60]]) for _ in range(dice.randint(0, 6))]
        rows.append((100 + i, dice.choice(["\n", " ", "\n\n"]).join(parts)))
    for i in range(40):  # near copies of one text
        copy = passages[2].split(" ") + passages[3].split(" ")
        for _ in range(dice.randint(0, 4)):
            copy[dice.randrange(len(copy))] = dice.choice(vocabulary)
        rows.append((1000 - i, " ".join(copy)))
    for i in range(80):  # a line that very many have
        rows.append((2000 + i, line + "\n" + " ".join(dice.choice(vocabulary) for _ in range(i % 9))))
    return rows


CLASHES = ("row", "key", "digest", "size", "cls", "n", "suspect", "copies", "score")


@pytest.fixture()
def docs(spark, messy):
    """The texts as a table of documents with columns that operators also use inside."""
    rows = [(k, t, "en" if i % 3 else None, f"s{i % 4}" if i % 7 else None, i, *range(len(CLASHES))) for i, (k, t) in enumerate(messy)]
    columns = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{c} int" for c in CLASHES)
    return spark.createDataFrame(rows, columns).repartition(5)


@pytest.fixture()
def nothing(docs):
    return docs.limit(0)
