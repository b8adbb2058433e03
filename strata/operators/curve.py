"""Morton keys: one order over several columns, in which files have narrow ranges of each of them.

Every column is cut into ranges that hold about equally many rows, and the bits of the range numbers are
interleaved. The key is a plain Column expression; only the borders come from the data, by one approximate-quantile
aggregate over the key columns.
"""

from __future__ import annotations

from os.path import commonprefix

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BooleanType,
    DataType,
    DateType,
    NumericType,
    StringType,
    TimestampNTZType,
    TimestampType,
)

BITS = 6  # ranges of a column: two to this power
ACCURACY = 10_000
_PREFIX_BYTES = 7  # a text is ordered by so many bytes after what all values have in common


def ordinal(column: str, kind: DataType, common: int = 0) -> Column:
    """A number that orders as the column does; NULL stays NULL."""
    value = F.col(column)
    if isinstance(kind, StringType):
        digits = F.substring(F.hex(value.cast("binary")), 2 * common + 1, 2 * _PREFIX_BYTES)
        return F.conv(F.rpad(digits, 2 * _PREFIX_BYTES, "0"), 16, 10).cast("bigint")
    if isinstance(kind, TimestampType):
        return F.unix_micros(value)
    if isinstance(kind, TimestampNTZType):
        return F.unix_micros(value.cast("timestamp"))
    if isinstance(kind, DateType):
        return F.unix_date(value).cast("bigint")
    if isinstance(kind, BooleanType):
        return value.cast("int").cast("bigint")
    if isinstance(kind, NumericType):
        return value.cast("double")
    raise ValueError(f"column {column} of type {kind.simpleString()} has no order to cluster by")


def _common_prefixes(df: DataFrame, texts: list[str]) -> dict[str, int]:
    """Bytes that all values of text columns share at their start: what the least and the greatest share."""
    if not texts:
        return {}
    ends = [F.struct(F.min(c).cast("binary"), F.max(c).cast("binary")) for c in texts]
    row = df.agg(*ends).first()
    return {c: len(commonprefix([bytes(low or b""), bytes(high or b"")])) for c, (low, high) in zip(texts, row, strict=True)}


def _range_number(value: Column, borders: list, first: int = 0) -> Column:
    """How many borders are not above the value, by bisection: as many comparisons as bits."""
    if not borders:
        return F.lit(first)
    middle = len(borders) // 2
    return F.when(value < F.lit(borders[middle]), _range_number(value, borders[:middle], first)).otherwise(
        _range_number(value, borders[middle + 1:], first + middle + 1)
    )


def interleaved(numbers: list[Column], bits: int = BITS) -> Column:
    """The bits of several numbers in turn, the highest first."""
    key = F.lit(0).cast("bigint")
    for bit in range(bits):
        for place, number in enumerate(reversed(numbers)):
            one = F.shiftright(number.cast("bigint"), bit).bitwiseAND(F.lit(1).cast("bigint"))
            key = key.bitwiseOR(F.shiftleft(one, bit * len(numbers) + place))
    return key


def with_morton_key(df: DataFrame, columns: tuple[str, ...], name: str = "_curve", bits: int = BITS) -> DataFrame:
    """Adds the Morton key of `columns`. NULLs come first in their column. The frame is read once or twice for the borders,
    key columns only."""
    if not 0 < bits * len(columns) <= 62:
        raise ValueError("a Morton key holds 62 bits")
    kinds = {c: df.schema[c].dataType for c in columns}
    common = _common_prefixes(df, [c for c in columns if isinstance(kinds[c], StringType)])
    ordinals = [ordinal(c, kinds[c], common.get(c, 0)) for c in columns]
    cuts = [i / (1 << bits) for i in range(1, 1 << bits)]
    found = df.agg(*(F.percentile_approx(o, cuts, ACCURACY) for o in ordinals)).first()
    names = [f"_ordinal{i}" for i in range(len(columns))]
    numbers = [
        F.when(F.col(o).isNull(), 0).otherwise(_range_number(F.col(o), sorted(set(borders or []))))
        for o, borders in zip(names, found, strict=True)
    ]
    prepared = df.withColumns(dict(zip(names, ordinals, strict=True)))
    return prepared.withColumn(name, interleaved(numbers, bits)).drop(*names)
