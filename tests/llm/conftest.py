import random

import pytest

SMALL = "/root/testdata/sf0.001"


def corpus(n=120, seed=5):
    """Documents with copies, near copies, shared lines and passages, and odd cases."""
    rng = random.Random(seed)
    vocab = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyzäé") for _ in range(rng.randint(2, 8))) for _ in range(400)]
    line = lambda k: " ".join(rng.choice(vocab) for _ in range(k)).capitalize() + "."
    shared, passage = line(12), line(40)
    out = [(0, None), (1, ""), (2, " \n\t "), (3, "One two"), (4, "one TWO"), (5, "a" * 500), (6, "12 34 !?"), (7, "x  y\n\n  z\t end ")]
    base = "\n".join(line(9) for _ in range(8))
    for i in range(8, n):
        kind = rng.randrange(8)
        text = "\n".join(line(rng.randint(3, 15)) for _ in range(rng.randint(1, 8)))
        if kind == 0:
            text = base
        elif kind == 1:
            found = base.split(" ")
            for _ in range(rng.randint(1, 4)):
                found[rng.randrange(len(found))] = rng.choice(vocab)
            text = " ".join(found)
        elif kind == 2:
            text += f"\n  {shared.upper()} \n" + line(4)
        elif kind == 3:
            text = line(5) + passage + line(rng.randint(1, 60))
        out.append((i, text))
    out.append((n, "\n".join(line(10) for _ in range(600))))
    return out


@pytest.fixture(scope="session")
def rows():
    return corpus()


@pytest.fixture(scope="session")
def docs(spark, rows):
    # extra columns with names that the operators use themselves
    return spark.createDataFrame([(i, t, "en", i, None) for i, t in rows], "doc_id long, text string, lang string, length long, id string").repartition(3)


@pytest.fixture(scope="session")
def empty(docs):
    return docs.limit(0)


@pytest.fixture(scope="session")
def odd(spark):
    """Repeated rows, null ids, and texts that share an id."""
    return spark.createDataFrame([(1, "same text here and there again"), (1, "same text here and there again"), (2, "Same text here and there again"), (None, "same text here and there again"), (None, None), (3, None), (3, "other words under one number")], "doc_id long, text string")
