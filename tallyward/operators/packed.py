"""Whole numbers of several columns side by side in a few words, each as narrow as the range of its values.

A wide row of amounts that has to travel through a shuffle by itself, because sums would not
shrink the rows, is mostly leading zeros. Packed, it is about as long as its digits.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyward.functions.sql import name

_WORD = 64
_WHOLE = (T.LongType, T.IntegerType, T.ShortType, T.ByteType)


@dataclass(frozen=True)
class Field:
    """A column's values less their lowest one, ``width`` bits from bit ``start`` on."""

    column: str
    lowest: int
    width: int
    start: int


@dataclass(frozen=True)
class Packing:
    """Where each column stands in the words. Null is packed as 0, so it is for columns that are summed."""

    fields: tuple[Field, ...]
    plain: tuple[str, ...] = ()
    #: No sum over the frame's rows, of whichever packed column, is larger in size.
    most: int = 0

    @classmethod
    def of(cls, df: DataFrame, columns: Sequence[str]) -> Packing:
        """The packing of a frame's columns, from one pass for their ranges; columns that are not whole numbers stay plain."""
        whole = [c for c in dict.fromkeys(columns) if isinstance(df.schema[c].dataType, _WHOLE)]
        plain = tuple(c for c in dict.fromkeys(columns) if c not in whole)
        if not whole:
            return cls((), plain)
        values = [f"coalesce(CAST({name(c)} AS BIGINT), 0)" for c in whole]
        rows, *found = df.agg(F.count("*"), *[F.expr(f"{f}({v})") for v in values for f in ("min", "max")]).first()
        fields, start = [], 0
        for c, lowest, highest in zip(whole, found[0::2], found[1::2]):
            lowest, highest = lowest or 0, highest or 0
            width = (highest - lowest).bit_length()
            if width >= _WORD:  # the difference is no long
                lowest = 0
            fields.append(Field(c, lowest, width, start))
            start += width
        return cls(tuple(fields), plain, rows * max(abs(x or 0) for x in found))

    @property
    def words(self) -> list[str]:
        bits = sum(f.width for f in self.fields)
        return [f"_word{k}" for k in range((bits + _WORD - 1) // _WORD)]

    def pack(self, df: DataFrame, keys: Sequence[str]) -> DataFrame:
        """The keys, the words and the plain columns."""
        pieces: list[list[str]] = [[] for _ in self.words]
        for f in self.fields:
            less = "" if f.lowest == 0 else f" - ({f.lowest}L)"
            value = f"(coalesce(CAST({name(f.column)} AS BIGINT), 0){less})"
            word, shift = divmod(f.start, _WORD)
            if f.width:
                pieces[word].append(f"shiftleft({value}, {shift})" if shift else value)
            if shift + f.width > _WORD:
                pieces[word + 1].append(f"shiftrightunsigned({value}, {_WORD - shift})")
        words = [f"{' | '.join(piece)} AS {word}" for word, piece in zip(self.words, pieces)]
        return df.selectExpr(*[name(k) for k in keys], *words, *[name(c) for c in self.plain])

    def unpack(self, df: DataFrame, keys: Sequence[str]) -> DataFrame:
        """The keys and the columns again."""
        values = []
        for f in self.fields:
            word, shift = divmod(f.start, _WORD)
            value = f"shiftrightunsigned(_word{word}, {shift})" if shift else f"_word{word}"
            if shift + f.width > _WORD:
                value = f"({value} | shiftleft(_word{word + 1}, {_WORD - shift}))"
            if f.width < _WORD:
                value = f"(({value}) & {(1 << f.width) - 1}L)"
            less = "" if f.lowest == 0 else f" + ({f.lowest}L)"
            values.append(f"{value}{less} AS {name(f.column)}" if f.width else f"{f.lowest}L AS {name(f.column)}")
        return df.selectExpr(*[name(k) for k in keys], *values, *[name(c) for c in self.plain])
