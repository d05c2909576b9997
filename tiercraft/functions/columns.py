"""Finding bronze columns whatever their headers look like, and cleaning their values.

Bronze text that does not parse becomes NULL (``try_*``), with ANSI mode on or off.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


# Texts that count as numbers and booleans.
WHOLE_NUMBER = r"^\s*([+-]?\d+)(?:\.\d*)?\s*$"
ONLY_FRACTION = r"^\s*[+-]?\.\d+\s*$"
TRUE_TEXT = r"(?i)^\s*(t|true|y|yes|1)\s*$"
FALSE_TEXT = r"(?i)^\s*(f|false|n|no|0)\s*$"


class Headers:
    """The headers of one bronze table, looked up by any accepted spelling.

    A spelling matches case-insensitively, or failing that with spaces and underscores ignored. Of two headers
    that come out alike the later one wins.
    """

    def __init__(self, columns: Sequence[str]):
        self.columns = list(columns)
        self._by_name = {c.lower(): c for c in self.columns}
        self._by_letters = {_letters(c): c for c in self.columns}

    def find(self, *spellings: str) -> str | None:
        for spelling in spellings:
            hit = self._by_name.get(spelling.lower(), self._by_letters.get(_letters(spelling)))
            if hit is not None:
                return hit
        return None

    def column(self, *spellings: str) -> Column:
        hit = self.find(*spellings)
        if hit is None:
            raise ValueError(f"no column for any of {list(spellings)}; the table has {self.columns}")
        return quoted(hit)

    def column_or_null(self, *spellings: str, dtype: str = "string") -> Column:
        hit = self.find(*spellings)
        return F.lit(None).cast(dtype) if hit is None else quoted(hit)


def _letters(name: str) -> str:
    return re.sub(r"[\s_]+", "", name.lower())


def quoted(name: str) -> Column:
    """A column by its exact name, dots and brackets included."""
    return F.col("`" + name.replace("`", "``") + "`")


def trimmed(value: Column) -> Column:
    """Text without the spaces around it (other white space stays)."""
    return F.trim(value.cast("string"))


def trim_lower(value: Column) -> Column:
    return F.lower(trimmed(value))


def nonempty(value: Column) -> Column:
    """Present and not blank."""
    return value.isNotNull() & (trimmed(value) != "")


def to_whole(value: Column, dtype: str = "int") -> Column:
    """Whole number; text such as ``7.9`` is cut to ``7`` and ``.5`` to ``0``, as a lenient cast does; other text is NULL.

    Text is taken apart first, because a cast that fails costs far more than one that succeeds.
    """
    text = value.cast("string")
    digits = F.regexp_extract(text, WHOLE_NUMBER, 1)
    from_text = F.nullif(digits, F.lit("")).try_cast(dtype)
    from_text = F.coalesce(from_text, F.when(text.contains(".") & text.rlike(ONLY_FRACTION), F.lit(0).cast(dtype)))
    return F.when(F.typeof(value) == "string", from_text).otherwise(value.try_cast(dtype))


def to_decimal(value: Column, precision: int = 18, scale: int = 8) -> Column:
    return trimmed(value).try_cast(f"decimal({precision},{scale})")


def to_ts(value: Column) -> Column:
    return value.try_cast("timestamp")


def to_bool(value: Column) -> Column:
    """Boolean; of texts the words Spark knows, others are NULL (without the cost of a failing cast)."""
    text = value.cast("string")
    from_text = F.when(text.rlike(TRUE_TEXT), True).when(text.rlike(FALSE_TEXT), False)
    return F.when(F.typeof(value) == "string", from_text).otherwise(value.try_cast("boolean"))


def to_date(value: Column) -> Column:
    return value.try_cast("date")


def decimals_to_double(df: DataFrame) -> DataFrame:
    """Every decimal column as double, for exports whose readers know no decimals."""
    return df.select(
        *[
            quoted(f.name).cast("double").alias(f.name) if f.dataType.typeName() == "decimal" else quoted(f.name)
            for f in df.schema.fields
        ]
    )


# A rule turns the column found in a table into the value stored for it.
Rule = Callable[[Column], Column]


def as_is(value: Column) -> Column:
    return value


def project(df: DataFrame, layout: Sequence[tuple]) -> DataFrame:
    """One select that renames and cleans: ``(output, rule, *spellings)`` per column."""
    headers = Headers(df.columns)
    return df.select(*[rule(headers.column(*spellings)).alias(out) for out, rule, *spellings in layout])
