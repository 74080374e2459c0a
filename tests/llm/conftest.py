from __future__ import annotations

import random

import pytest

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long,"
    " score double, kept boolean, size string, row long, key string,"
    " label int, _id long, best string, shard long, w string, hash long, range long"
)
#: Values of the columns whose names clash with those that operators use inside.
CLASHING = (0.5, True, "big", 4, "k", 1, 3, "b", 5, "w", 6, 7)


def prose(rng: random.Random, n: int) -> str:
    letters = ["the", "of", "and", "in", "to"] + [
        "".join(rng.choice(("an", "er", "ti", "on", "sh", "é", "th")) for _ in range(rng.randrange(1, 5)))
        for _ in range(200)
    ]
    out = []
    for i in range(n):
        w = rng.choice(letters)
        if i % 9 == 0:
            w = w.capitalize()
        if i % 9 == 8:
            w += "."
        out.append(w + ("\n" if i % 47 == 46 else " "))
    return "".join(out).strip()


def awkward_rows() -> list[tuple]:
    """Nulls in every column, empty, blank and long texts, copies, near copies, repeated rows."""
    rng = random.Random(7)
    texts: list[str | None] = [None, "", " \t\n ", "one", "Two words", "a  b\n\n c \x0b d"]
    texts += [prose(rng, n) for n in (12, 30, 60, 60, 90, 120, 150, 200, 300, 9000)]
    base = prose(rng, 200)
    words = base.split(" ")
    texts += [base, base, base.upper(), " ".join([*words[:-1], "changed"]), " ".join(words[:100])]
    texts += ["junk### " * 3 + prose(rng, 15), "same same " * 40, prose(rng, 40) + "\n" + prose(rng, 3) * 2]
    texts += [f"{w}*** {w}&&&" for w in ("x", "yy")]
    rows = []
    for i, t in enumerate(texts):
        rows.append((i * 3, t, "en", f"s{i % 4}", len(t or ""), *CLASHING))
    none = (None,) * len(CLASHING)
    rows.append((None, texts[8], None, None, None, *none))
    rows.append((None, "another text without an id", None, None, None, *none))
    rows.append(rows[9])
    rows.append(rows[9])
    rows.append(rows[1])
    return rows


@pytest.fixture(scope="session")
def rows():
    return awkward_rows()


@pytest.fixture(scope="session")
def awkward(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)
