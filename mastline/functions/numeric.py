"""Coercing casts, half-even rounding and order-independent sums."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Readings are summed as decimals of twelve places; what doubles leave beyond is noise.
_PLACES = "decimal(25,12)"
_LIMIT = 1e13
_SQUARE_LIMIT = 1e9

# Number spellings.
_WHOLE = r"^\s*[+-]?\d{1,18}\s*$"
_WHOLE_LONG = r"^\s*[+-]?\d{19}\s*$"
_NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"
_INFINITE = r"^ *[+-]?(?i:inf|infinity) *\z"


def nan_to_null(c: Column) -> Column:
    return F.nanvl(c, F.lit(None).cast("double"))


def is_whole_text(c: Column) -> Column:
    """Whole-number text that a bigint holds; of 19 digits only some do."""
    return F.rlike(c, F.lit(_WHOLE)) | (F.rlike(c, F.lit(_WHOLE_LONG)) & c.try_cast("bigint").isNotNull())


def is_number_text(c: Column) -> Column:
    return F.rlike(c, F.lit(_NUMBER)) | F.rlike(c, F.lit(_INFINITE))


def text_to_double(c: Column) -> Column:
    """Number text to double; anything else to NULL.

    Text is matched before it is cast: a failing ``try_cast`` raises inside,
    some 20 microseconds a value, and the JVM parser would also accept
    ``1.5f``, ``2d`` and hex floats.
    """
    return F.when(is_number_text(c), c.try_cast("double"))


def text_to_long(c: Column) -> Column:
    """Whole-number text to bigint (``101``, ``101.0``, ``1e3``); else NULL."""
    return F.when(is_whole_text(c), c.try_cast("bigint")).otherwise(double_to_long(text_to_double(c)))


def double_to_long(d: Column) -> Column:
    return F.when(F.rint(d) == d, d.try_cast("bigint"))


def as_double(df: DataFrame, name: str) -> Column:
    """Column ``name`` as a NaN-free double, whatever type it arrives in."""
    if isinstance(df.schema[name].dataType, T.StringType):
        return text_to_double(F.col(name))
    return nan_to_null(F.col(name).cast("double"))


def as_long(df: DataFrame, name: str) -> Column:
    """Column ``name`` as bigint; fractions and non-numbers become NULL."""
    kind = df.schema[name].dataType
    if isinstance(kind, T.StringType):
        return text_to_long(F.col(name))
    if isinstance(kind, T.IntegralType):
        return F.col(name).cast("bigint")
    return double_to_long(F.col(name).cast("double"))


def round_half_even(c: Column, places: int) -> Column:
    scale = float(10**places)
    return F.rint(c * scale) / scale


class Moments:
    """Sum, mean and deviation that do not depend on row order, from states that can be merged.

    Double addition gives a different last bit for each order of rows, which
    flips rounding ties from one run to the next.  Every finite value below 1e13
    is therefore added as a decimal of twelve places, whatever its own places and
    however many rows there are, and for the deviation so is the square (to eleven places) of
    every value below 1e9.  Only a group with an infinite or larger value uses plain
    double sums.
    """

    def __init__(self, name: str, squares: bool = False):
        self.name = name
        self._units, self._square = f"__{name}_units", f"__{name}_square"
        self._n, self._n_units, self._plain = (f"__{name}_{x}" for x in ("n", "n_units", "plain"))
        self._n_square, self._plain_square = (f"__{name}_{x}" for x in ("n_square", "plain_square"))
        self.squares = squares

    def prepare(self, df: DataFrame) -> DataFrame:
        """Add the decimal forms of the column (NULL where it has none)."""
        x = F.col(self.name)
        df = df.withColumn(self._units, F.when(F.abs(x) < _LIMIT, x.try_cast(_PLACES)))
        if self.squares:
            units = F.when(F.abs(x) < _SQUARE_LIMIT, F.col(self._units))
            df = df.withColumn(self._square, units * units)
        return df

    def state(self) -> list[Column]:
        """Aggregates over prepared rows."""
        x, units = F.col(self.name), F.col(self._units)
        out = [
            F.count(x).alias(self._n),
            F.count(units).alias(self._n_units),
            F.sum(units).alias(self._units),
            F.sum(x).alias(self._plain),
        ]
        if self.squares:
            out += [
                F.count(self._square).alias(self._n_square),
                F.sum(self._square).alias(self._square),
                F.sum(x * x).alias(self._plain_square),
            ]
        return out

    def merge(self) -> list[Column]:
        """Aggregates that put several states together."""
        names = [self._n, self._n_units, self._units, self._plain]
        if self.squares:
            names += [self._n_square, self._square, self._plain_square]
        return [F.sum(c).alias(c) for c in names]

    def sum(self) -> Column:
        """NULL-skipping sum; NULL for a group without values."""
        exact = F.when(F.col(self._n_units) == F.col(self._n), F.col(self._units).cast("double"))
        return nan_to_null(F.coalesce(exact, F.col(self._plain)))

    def mean(self) -> Column:
        return F.try_divide(self.sum(), F.col(self._n))

    def deviation(self) -> Column:
        """Deviation of a sample; NULL for a single value.

        With q the mean rounded to nine places and r what that leaves of the sum, the squared
        distances from the mean add up to (squares - q * (sum + r)) - r * r / n: the difference is
        taken between decimals, so nothing cancels.
        """
        n, total = F.col(self._n), F.col(self._units).try_cast("decimal(35,12)")
        rows = n.try_cast("decimal(12,0)")
        q = F.try_divide(total, rows).try_cast("decimal(18,9)")
        r = total - q * rows
        both = total + r
        # Nine places of it make the product exact; what the others add is less than 1e-9 of a mean.
        narrow = both.try_cast("decimal(19,9)")
        about = F.coalesce((q * narrow).try_cast("decimal(38,11)"), (q * both).try_cast("decimal(38,11)"))
        lost = F.coalesce((both - narrow).cast("double") * q.cast("double"), F.lit(0.0))
        exact = (F.col(self._square) - about).cast("double") - lost - F.try_divide(F.pow(r.cast("double"), F.lit(2.0)), n)
        plain = F.col(self._plain_square) - F.try_divide(F.col(self._plain) * F.col(self._plain), n)
        spread = F.when(F.col(self._n_square) == n, exact).otherwise(plain)
        return nan_to_null(F.when(n > 1, F.sqrt(F.greatest(spread, F.lit(0.0)) / (n - 1))))
