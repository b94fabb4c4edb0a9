"""Rows that every operator must cope with, and small helpers."""

import collections
import random

SF = "/root/testdata/sf0.001"

WORDS = ("the inner thing was on their other hand and it held the line again with a small amount of water near "
         "every open door of that house where nobody had ever asked for anything").split()


def prose(seed, n, words=WORDS):
    rnd = random.Random(seed)
    return " ".join(rnd.choice(words) for _ in range(n))


def documents(spark, rows, extra=True):
    """(doc_id, text) rows as a table like ``documents``, with extra columns whose names operators use inside."""
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    data = [(i, t, None if k % 5 == 0 else "en", None if k % 7 == 0 else "s", None if t is None else len(t))
            for k, (i, t) in enumerate(rows)]
    df = spark.createDataFrame(data, schema)
    if extra:
        for name in ("_row", "_fp", "node", "u", "gram", "n", "kept", "score", "_cut", "_number", "id", "line"):
            df = df.selectExpr("*", f"'x' as {name}")
    return df


def odd_rows():
    """Nulls, empty and blank texts, one very long text, repeated rows, equal texts under several ids."""
    same = prose(1, 60)
    return [(None, same), (None, None), (1, None), (2, ""), (3, " \t\n "), (4, same), (5, same), (5, same), (6, "x"),
            (7, "é世界\u0000 " * 20), (8, prose(2, 30_000)), (9, "a" * 60_000), (10, "\n".join([prose(3, 12)] * 3))]


def counted(rows):
    return collections.Counter(tuple(r) for r in rows)


class Union:
    def __init__(self):
        self.up = {}

    def find(self, x):
        self.up.setdefault(x, x)
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x

    def join(self, a, b):
        a, b = self.find(a), self.find(b)
        self.up[max(a, b)] = min(a, b)
