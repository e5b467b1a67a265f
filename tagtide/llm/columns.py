"""Columns of a table kept apart from those that an operator makes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class Shield:
    """Stands in for all columns of ``docs`` by position, so that no name can clash."""

    def __init__(self, docs: DataFrame, *needed: str):
        self.columns = docs.columns
        self.names = tuple(f"_c{i}" for i in range(len(self.columns)))
        kept = [F.col(f"`{c}`").alias(n) for c, n in zip(self.columns, self.names, strict=True)]
        self.plain = docs.select(*needed, *kept)

    def of(self, column: str) -> str:
        return self.names[self.columns.index(column)]

    def back(self, rows: DataFrame, *more: str) -> DataFrame:
        """The table's own columns again, and ``more``."""
        kept = [F.col(n).alias(c) for c, n in zip(self.columns, self.names, strict=True)]
        return rows.select(*kept, *more)


def with_length(rows: DataFrame, shield: Shield, changed: Column) -> DataFrame:
    """Sets ``n_chars``, if the table has one, to the text's length where it is ``changed``."""
    if "n_chars" not in shield.columns:
        return rows
    length = F.char_length(F.col(shield.of("text"))).cast("long")
    name = shield.of("n_chars")
    return rows.withColumn(name, F.when(changed, length).otherwise(F.col(name)))
