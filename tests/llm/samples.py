"""Small tables with the awkward rows every operator has to take."""

from __future__ import annotations

import random

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
#: Names that the operators use inside.
CLASHES = ("row", "hash", "number", "n", "score", "spans", "ids", "batch", "label", "class", "order", "queue", "stretch", "key")


def awkward(seed: int = 7) -> list[tuple]:
    rnd = random.Random(seed)
    words = [f"{a}{b}" for a in "wxyz" for b in ("an", "el", "io", "um", "é", "ñ")]
    prose = lambda n: " ".join(rnd.choice(words) for _ in range(n))
    shared, base = prose(80), prose(120)
    texts = [prose(rnd.choice([0, 1, 4, 5, 30, 90])) for _ in range(30)]
    texts += [f"{prose(20)}\n{shared}\n{prose(20)}" for _ in range(6)]
    texts += [base, base, base + " end", base.replace("wan", "Wan", 1), "", "   \n\t ", "12 34 !?", None, None]
    texts += [prose(6000), "a" * 5000, "one\x00two \x01 <|endoftext|> \x1c 　x"]
    rows = [(i, t, rnd.choice(["en", "fr", None]), rnd.choice(["a", "a", "b", None]), 0) for i, t in enumerate(texts)]
    return rows + rows[:4] + [(3, "another text under an id that is taken " * 4, "en", "b", 0)]


def table(spark, rows=None, clashes: bool = False):
    """The awkward rows in several partitions; with ``clashes`` also columns the operators might trip over."""
    from pyspark.sql import functions as F

    rows = awkward() if rows is None else rows
    made = spark.createDataFrame(rows, SCHEMA)
    made = made.repartition(4) if rows else made
    return made.withColumns({name: F.lit(f"own {name}") for name in CLASHES}) if clashes else made


def collected(frame) -> list[tuple]:
    return sorted((tuple(row) for row in frame.collect()), key=repr)
