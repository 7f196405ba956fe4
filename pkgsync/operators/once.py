"""Costly columns that are worked out once per row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def evaluated_once(df: DataFrame, **columns: Column) -> DataFrame:
    """``df`` with the columns as the fields of a one-element array that is unrolled.

    Catalyst copies a projected expression into every filter and join condition on it, and again into each branch that
    uses it, so a path would be cut up and a document parsed many times over; it does not look through a generator.
    """
    names = [c for c in df.columns if c not in columns]
    return df.select(*names, F.inline(F.array(F.struct(*[c.alias(n) for n, c in columns.items()]))))
