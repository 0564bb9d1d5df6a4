"""Quantity × price in the inputs' own types, and sums of it that are exact and
do not depend on the order of the rows.

Whole numbers and decimals multiply to a decimal that holds every digit
(``int × decimal(10,2)`` is ``decimal(21,2)``) and are summed as
``decimal(38, s)``.  Where an input is a floating number the product is a
double, as the inputs are.  Doubles do not add up to the same total in every
order, so each is split into two integer limbs, its whole units and the rest in
billionths, whose sums are exact in long arithmetic (no object per row, unlike
a decimal sum) and merge in any order:

* a group may hold 9e9 lines and 9e18 whole units; passing either is an
  arithmetic error (ANSI mode, Spark's default) and not a wrong total;
* digits below a billionth are rounded per line;
* NaN, infinite values and lines beyond 1e15 (which have no billionths to
  keep) are summed apart, as doubles.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

NANO = 1_000_000_000
WIDE = 1e15

_DIGITS = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 19}


def _decimal(t: T.DataType) -> T.DecimalType | None:
    """The decimal that holds every value of ``t``; None if it is floating."""
    if isinstance(t, T.DecimalType):
        return t
    digits = _DIGITS.get(type(t))
    return T.DecimalType(digits, 0) if digits else None


def product_type(quantity: T.DataType, price: T.DataType) -> T.DataType:
    """The type of ``quantity × price``: a decimal with every digit, or double.
    Where 38 digits cannot hold them all, decimals after the sixth are given
    up first, as Spark's own multiplication does."""
    q, p = _decimal(quantity), _decimal(price)
    if q is None or p is None:
        return T.DoubleType()
    digits, scale = q.precision + p.precision + 1, q.scale + p.scale
    if digits > 38:
        scale = max(38 - (digits - scale), min(scale, 6))
    return T.DecimalType(min(38, digits), scale)


def line_value(quantity: Column, price: Column, types: tuple[T.DataType, T.DataType]) -> Column:
    """``quantity × price`` for columns of these two types (see :func:`product_type`)."""
    if isinstance(product_type(*types), T.DoubleType):
        return quantity.cast("double") * price.cast("double")
    return quantity.cast(_decimal(types[0])) * price.cast(_decimal(types[1]))


@dataclass(frozen=True)
class ExactSum:
    """Columns that carry the sum of a value of type ``kind`` from one
    aggregate to the next; ``name`` begins their names."""

    name: str
    kind: T.DataType

    @classmethod
    def of(cls, df: DataFrame, value: str, name: str = "spend") -> ExactSum:
        return cls(name, df.schema[value].dataType)

    @property
    def _double(self) -> bool:
        return isinstance(self.kind, T.DoubleType)

    @property
    def columns(self) -> list[str]:
        limbs = ("whole", "nano", "wide") if self._double else ("whole",)
        return [f"{self.name}_{x}" for x in limbs]

    def first(self, value: Column) -> list[Column]:
        """Aggregates over the values themselves."""
        if not self._double:
            return [F.sum(value.cast(T.DecimalType(38, self.kind.scale))).alias(self.columns[0])]
        plain = F.abs(value) < WIDE  # false for NaN, which sorts above all numbers
        whole = F.when(plain, F.floor(value))
        nano = F.floor((F.when(plain, value) - whole) * NANO + F.lit(0.5))
        parts = [F.sum(whole), F.sum(nano), F.sum(F.when(~plain, value))]
        return [c.alias(n) for c, n in zip(parts, self.columns, strict=True)]

    def merged(self) -> list[Column]:
        """Aggregates over rows that carry sums."""
        return [F.sum(n).alias(n) for n in self.columns]

    def carried(self) -> list[Column]:
        """The sums with the billionths' whole units carried over, so that a
        further merge starts from small numbers again."""
        if not self._double:
            return [F.col(self.columns[0])]
        whole, nano, wide = self.columns
        return [
            (F.col(whole) + F.expr(f"{nano} div {NANO}")).alias(whole),
            F.pmod(nano, F.lit(NANO)).alias(nano), F.col(wide),
        ]

    def total(self) -> Column:
        """The sum in the value's type; NULL if there was no value."""
        if not self._double:
            return F.col(self.columns[0])
        whole, nano, wide = (F.col(c) for c in self.columns)
        carry = F.expr(f"{self.columns[1]} div {NANO}")
        exact = (whole + carry).cast("double") + F.pmod(nano, F.lit(NANO)).cast("double") / NANO
        return F.when(wide.isNull(), exact).otherwise(wide + F.coalesce(exact, F.lit(0.0)))
