"""Small tables with the awkward cases: nulls, empty and long texts, repeats, clashing columns."""

import random

WORDS = ("the of and to in a is that it for on was as with be by are from at "
         "river stone window garden letter morning paper bridge yellow engine").split()


def text(seed: int, n: int) -> str:
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) + rng.choice(["", "", "ing", "er", "ly", str(rng.randrange(99))])
                    for _ in range(n))


def awkward() -> list[tuple]:
    """(doc_id, text, h): h is an extra column whose name an operator uses inside."""
    passage = text(1, 60)
    near = text(2, 120).split()
    other = list(near)
    other[50] = "changed"
    rows = [(1, text(3, 80) + " " + passage, "x"), (2, passage + "\n" + text(4, 50), None),
            (3, None, "x"), (4, "", "x"), (5, "   \n\t ", "x"), (None, text(5, 70), "x"),
            (None, None, None), (6, text(6, 6000), "long"), (7, " ".join(near), "x"),
            (8, " ".join(other), "x"), (9, " ".join(near), "x"), (10, "ab " * 300, "x"),
            (11, "é" * 250 + " Ünï " + passage, "x"), (12, text(7, 90), "x"), (12, text(7, 90), "x"),
            (13, text(6, 6000)[2000:9000], "x"), (-5, text(8, 3), "x"), (14, text(4, 50), "x")]
    return rows


SCHEMA = "doc_id long, text string, h string"


def frame(spark, rows=None):
    return spark.createDataFrame(awkward() if rows is None else rows, SCHEMA).repartition(3)
