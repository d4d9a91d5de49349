"""Awkward rows that every document operator must take."""

from __future__ import annotations

LONG = "lorem ipsum dolor " * 20_000

# id, text, and columns named like working columns of the operators
ROWS = [
    (1, "plain words about nothing in particular at all", "x", 7, "a"),
    (2, None, None, None, None),
    (3, "", "x", 7, "a"),
    (4, " \t\n", "x", 7, "a"),
    (5, "plain words about nothing in particular at all", "y", 8, "b"),
    (5, "plain words about nothing in particular at all", "y", 8, "b"),
    (None, "plain  words about\nnothing in particular at all", None, 1, "c"),
    (None, None, None, None, None),
    (6, "naïve \U0001f600 café 中文 \x1c\x85 ſK", "x", 7, "a"),
    (7, LONG, "x", 7, "a"),
    (8, "one", "x", 7, "a"),
]
SCHEMA = "doc_id long, text string, id string, n long, digest string"


def awkward(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def sort_key(row):
    return tuple((v is None, str(v)) for v in row)


def same_rows(a, b) -> bool:
    return sorted(map(tuple, a), key=sort_key) == sorted(map(tuple, b), key=sort_key)
