import random

import pytest

WORDS = [f"{a}{b}" for a in ("than", "ous", "ther", "ing", "mo", "re", "ty", "lun", "pa", "ke") for b in ("da", "st", "lo", "ma", "ne", "rk", "fi", "so")]
SCHEMA = "text string, doc_id long, doc long, source string, n long, lang string, n_chars long, h string"


def passage(rng, n):
    return [rng.choice(WORDS) for _ in range(n)]


@pytest.fixture(scope="session")
def texts():
    """Pairs (id, text): copies, near copies, a shared passage, short, empty, null, very long and repeated rows, a null id."""
    rng = random.Random(5)
    out = []
    base = [passage(rng, rng.randint(30, 120)) for _ in range(12)]
    common = passage(rng, 40)
    for i, words in enumerate(base):
        out.append((10 * i, " ".join(words)))
        out.append((10 * i + 1, " ".join(words)))  # an exact copy
        near = list(words)
        for _ in range(rng.randint(0, 4)):
            near[rng.randrange(len(near))] = rng.choice(WORDS)
        out.append((10 * i + 2, " ".join(near).upper() + "\n"))
        out.append((10 * i + 3, " ".join(passage(rng, 30) + common + passage(rng, 30))))
    cluster = passage(rng, 60)
    for i in range(40):  # a group of near copies
        words = list(cluster)
        words[rng.randrange(60)] = rng.choice(WORDS)
        out.append((1000 + i, " ".join(words)))
    long = passage(rng, 60_000)
    out += [(2000, ""), (2001, None), (2002, " \t\n"), (2003, "one two"), (2004, "ONE  two"), (2005, "one two three four five"), (2006, " ".join(long)), (2007, " ".join(long[:50_000])), (2008, "a" * 5000), (2009, "ñandú " * 40)]
    out += [(2010, "same row twice " * 20), (2010, "same row twice " * 20), (None, "no id here but words in plenty for a set")]
    return out


def frame(spark, texts):
    """Columns in another order and with names that operators use inside."""
    rows = [(t, i, 7, ["s1", "s2", None][x % 3] if x % 2 else "hot", x, None, None if t is None else len(t), "x") for x, (i, t) in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def docs(spark, texts):
    return frame(spark, texts).cache()


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
