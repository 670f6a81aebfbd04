"""Value repair for dirty text and number columns."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def money(text: Column, precision: int = 12, scale: int = 2) -> Column:
    """Decimal from currency text such as ``$1,234.50``; NULL if it is not a number."""
    return F.regexp_replace(text, "[$,]", "").try_cast(T.DecimalType(precision, scale))


def yes_no(text: Column) -> Column:
    """Boolean from ``t`` / ``f`` text."""
    return F.when(text == "t", F.lit(True)).when(text == "f", F.lit(False))


def nan_to_null(number: Column) -> Column:
    return F.when(~F.isnan(number), number)


def blank_to_zero(text: Column, to: str = "double") -> Column:
    """Number from text in which a blank stands for zero."""
    return F.when(text == "", F.lit(0)).otherwise(text.try_cast(to)).cast(to)


def cast_columns(df: DataFrame, types: Mapping[str, str | T.DataType]) -> DataFrame:
    """Cast many columns at once; values that do not fit become NULL."""
    return df.withColumns({name: F.col(name).try_cast(to) for name, to in types.items()})


def fill_text(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Replace NULL by the empty string in text columns."""
    names = columns or [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    return df.na.fill("", subset=names)
