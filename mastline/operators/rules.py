"""Column rules as rows of a configuration table, worked into one plan.

A rule names a column, its kind, whether it is part of the key, and the values it may have.
Rules are read once, one row per column; what follows from them are plain expressions, so a
configured ingestion has the plan that the same rules written by hand would have.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mastline.constants import EXPECTED_KINDS, NATURAL_KEY, SIGNAL_MAX, SIGNAL_MIN, VOLUME_MIN
from mastline.functions.numeric import as_double, as_long
from mastline.operators.dedup import keep_first
from mastline.session import small_frame

SHAPE = "place int, column_name string, kind string, in_key boolean, low double, high double"


class RuleError(ValueError):
    """A rule that cannot be followed."""


def reading_rules(spark: SparkSession) -> DataFrame:
    """The rules of cell-tower readings as such a table."""
    bounds = {"signal_strength": (SIGNAL_MIN, SIGNAL_MAX), "data_volume_mb": (VOLUME_MIN, None)}
    rows = [(i, c, kind, c in NATURAL_KEY, *bounds.get(c, (None, None))) for i, (c, kind) in enumerate(EXPECTED_KINDS.items())]
    return small_frame(spark, rows, SHAPE)


class Rules:
    """The rules of a table, in order of their place."""

    def __init__(self, table: DataFrame):
        self.rows = table.orderBy("place").collect()  # one per column
        names = [r.column_name for r in self.rows]
        unknown = [r.kind for r in self.rows if r.kind not in ("int", "float", "object")]
        if unknown or len(set(names)) < len(names) or None in names:
            raise RuleError(f"kinds {unknown}, columns {names}: each column needs one rule of kind int, float or object")
        self.key = [r.column_name for r in self.rows if r.in_key]

    def typed(self, df: DataFrame) -> DataFrame:
        """Columns of ``df`` with a rule, cast to its kind; what cannot be read becomes NULL."""
        casts = {"int": as_long, "float": as_double}
        present = [r for r in self.rows if r.column_name in df.columns and r.kind in casts]
        return df.withColumns({r.column_name: casts[r.kind](df, r.column_name) for r in present})

    def clean(self, df: DataFrame, order: list[str], date: str = "_execution_date") -> DataFrame:
        """Typed rows with a complete key, the first of each key and date."""
        typed = self.typed(df)
        for name in self.key:
            typed = typed.where(F.col(name).isNotNull())
        return keep_first(typed, [*self.key, date], order)

    def _outside(self, rule) -> Column | None:
        value, sides = F.col(rule.column_name), []
        if rule.low is not None:
            sides.append(value < rule.low)
        if rule.high is not None:
            sides.append(value > rule.high)
        return (sides[0] | sides[1]) if len(sides) > 1 else sides[0] if sides else None

    def counts(self, df: DataFrame, date: str = "_execution_date") -> DataFrame:
        """(execution_date, column_name, n_rows, n_missing, n_unreadable, n_outside) by one pass over ``df``."""
        present = [r for r in self.rows if r.column_name in df.columns]
        raw = df.select(F.col(date).alias("execution_date"), *(F.col(r.column_name).alias(f"__{r.column_name}") for r in present), *(r.column_name for r in present))
        typed = self.typed(raw)

        def counted(rule) -> Column:
            value, given = F.col(rule.column_name), F.col(f"__{rule.column_name}")
            outside = self._outside(rule)
            return F.struct(
                F.lit(rule.column_name).alias("column_name"),
                F.count("*").alias("n_rows"),
                F.count_if(given.isNull()).alias("n_missing"),
                F.count_if(given.isNotNull() & value.isNull()).alias("n_unreadable"),
                (F.lit(0).cast("bigint") if outside is None else F.count_if(outside)).alias("n_outside"),
            )

        per_date = typed.groupBy("execution_date").agg(F.array(*map(counted, present)).alias("counts"))
        return per_date.select("execution_date", F.inline("counts"))
