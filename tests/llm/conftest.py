import random

import pytest

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that operators use inside; as extra columns they must not disturb.
CLASHING = ["h1", "position", "site", "fp", "component", "size", "rank", "weight", "part", "group", "place", "estimate", "count", "ratio", "cell", "low"]


def corpus(seed: int = 5, n: int = 120) -> list[tuple]:
    """Documents with copies, near copies, boilerplate, junk, nulls, one long text and repeated rows."""
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 7))) for _ in range(400)]
    boiler = ["  Share this page with friends today  ", "All rights are reserved by the site", "Ünïcode footer — ça va"]
    sentence = lambda k: " ".join(rng.choice(vocabulary) for _ in range(k)).capitalize() + "."
    texts: list[str | None] = []
    for i in range(n):
        kind = i % 12
        lines = [sentence(rng.randint(3, 30)) for _ in range(rng.randint(1, 5))]
        if kind in (3, 4, 5):
            lines.insert(rng.randrange(len(lines) + 1), rng.choice(boiler))
        if kind == 6 and texts:
            texts.append(rng.choice(texts))
        elif kind == 7 and texts and texts[-1]:
            words = texts[-1].split(" ")
            words[rng.randrange(len(words))] = "changed"
            texts.append(" ".join(words))
        elif kind == 8:
            texts.append(" ".join(w + "###" for w in lines[0].split()) * 3)
        else:
            texts.append("\n".join(lines))
    texts[0], texts[1], texts[2] = None, "", " \n\t "
    texts[9] = "\n".join(sentence(12) for _ in range(900))
    rows = []
    for i, t in enumerate(texts):
        lang = None if i == 10 else rng.choice(["en", "fr"])
        source = None if i % 17 == 11 else ("hot" if i % 3 == 0 else f"s{i % 14:02d}")
        rows.append((i, t, lang, source, None if t is None else len(t)))
    return rows + [rows[20], rows[20], (None, "a text without an id that is long enough to be kept by any rule at all", "en", "hot", 10)]


@pytest.fixture(scope="session")
def rows():
    return corpus()


@pytest.fixture(scope="session")
def docs(spark, rows):
    from pyspark.sql import functions as F

    df = spark.createDataFrame(rows, DOCUMENTS).repartition(5)
    return df.select("*", *(F.lit(7).alias(c) for c in CLASHING))


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCUMENTS)
