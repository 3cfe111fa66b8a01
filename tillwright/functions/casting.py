"""Typing of raw columns. Text that does not parse becomes null instead of failing the job."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DateType, StringType


def parse_date(text: Column, pattern: str = "yyyy-MM-dd") -> Column:
    return F.try_to_date(text, pattern)


def parse_flag(text: Column) -> Column:
    """Boolean of "Y"/"N" (and the other spellings Spark's boolean cast knows)."""
    return text.try_cast("boolean")


def typed_columns(df: DataFrame, types: dict[str, DataType]) -> dict[str, Column]:
    """Expression for each column of `types` that does not have its type yet."""
    actual = {field.name: field.dataType for field in df.schema}
    columns = {}
    for name, wanted in types.items():
        if actual[name] == wanted:
            continue
        column = F.col(name)
        if wanted == DateType() and actual[name] == StringType():
            columns[name] = parse_date(column)
        else:
            columns[name] = column.try_cast(wanted)
    return columns
