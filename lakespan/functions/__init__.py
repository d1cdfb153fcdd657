"""Predicates that reads push down, sets of values, and functions in Python for what expressions can't say."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def predicates(number: str, text: str) -> dict[str, Column]:
    """The twelve shapes of filters over a number and a text column."""
    n, t = F.col(number), F.col(text)
    return {
        "eq": n == 3, "gt": n > 5, "ge": n >= 5, "lt": n < 4, "le": n <= 4, "in": n.isin(1, 2, 7), "is_null": t.isNull(), "is_not_null": t.isNotNull(),
        "not": ~(n == 3), "starts": t.startswith("L"), "ends": t.endswith("E"), "contains": t.contains("I"),
    }


def as_set(array: str) -> Column:
    """A set's values: distinct, in order."""
    return F.array_sort(F.array_distinct(array))


def soundex_distance(a: str, b: str) -> Column:
    """How many of the four signs of two texts' sound codes differ."""

    @F.pandas_udf("int")
    def differing(x: pd.Series, y: pd.Series) -> pd.Series:
        return pd.Series([None if p is None or q is None else sum(i != j for i, j in zip(p, q, strict=False)) for p, q in zip(x, y, strict=True)], dtype="Int32")

    return differing(F.soundex(a), F.soundex(b))


@F.udtf(returnType="place int, word string")
class Words:
    """A row for each word of a text, with its place from 0."""

    def eval(self, text: str):
        for i, w in enumerate((text or "").split(" ")):
            yield i, w
