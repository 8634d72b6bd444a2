"""Text forms used in check messages."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _quoted(names: Column) -> Column:
    return F.array_join(F.transform(names, lambda n: F.concat(F.lit("'"), n, F.lit("'"))), ", ")


def name_list(names: Column) -> Column:
    """``['a', 'b']`` in the order given."""
    return F.concat(F.lit("["), _quoted(names), F.lit("]"))


def name_set(names: Column) -> Column:
    """``{'a', 'b'}`` in name order."""
    return F.concat(F.lit("{"), _quoted(F.array_sort(names)), F.lit("}"))
