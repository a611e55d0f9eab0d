"""A small table with every awkward case, and an empty one like it."""

from __future__ import annotations

import random

CLASHING = ("row", "key", "h", "line", "spans", "kinds", "words", "lines", "id", "n_lines", "kept", "rank", "score", "block", "number", "size", "slot", "part")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{c} string" for c in CLASHING)


def prose(seed: int, n: int) -> str:
    r = random.Random(seed)
    return " ".join("".join(r.choice(["an", "the", "or", "st", "ed", "ing", "li"]) for _ in range(r.randint(1, 4))) for _ in range(n))


LONG = "\n".join(prose(900 + i, 40) for i in range(150))
TEXTS: list[tuple[int | None, str | None]] = [
    (1, None),
    (2, ""),
    (None, prose(1, 60)),
    (None, None),
    (3, LONG),
    (4, prose(2, 80)),
    (4, prose(2, 80)),  # a repeated row
    (5, prose(2, 80)),  # an equal text
    (6, prose(2, 79) + " other"),  # a near copy
    (7, " \n\t \n"),
    (8, "word"),
    (9, "4711 * 42 %% ## ||"),
    (10, "é\U0001f600 \x1c tab\ttab\r\nline"),
    (11, 'Token: "abcdefgh" and AKIA' + "Z" * 16 + " " + "0f" * 12 + "\npassword=abc secret = abcdef"),
    (12, "a" * 5000),
    (13, prose(3, 30) + "\n" + prose(4, 30) + "\n" + prose(3, 30)),
    (14, prose(3, 29) + " changed\n\n" + prose(5, 30)),
    (14, prose(6, 25)),  # the same id with another text
]


def rows(texts=TEXTS):
    return [(i, t, "xx" if (i or 0) % 2 else None, None, None if t is None else len(t), *["extra"] * len(CLASHING)) for i, t in texts]


def docs(spark):
    return spark.createDataFrame(rows(), SCHEMA).repartition(3)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def write(spark, df, path) -> str:
    df.write.parquet(f"{path}/documents.parquet")
    return str(path)
