"""Comparing rows with a given row under a multi-column order, NULLs included."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Key:
    """One sort key. As in Spark's default, NULL comes first ascending and last descending; ``nulls_last`` puts it last
    ascending too."""

    column: str
    descending: bool = False
    nulls_last: bool = False

    def sort(self) -> Column:
        c = F.col(self.column)
        if self.descending:
            return c.desc()
        return c.asc_nulls_last() if self.nulls_last else c.asc()

    def strictly_after(self, value: Any) -> Column:
        c = F.col(self.column)
        if self.descending:
            return F.lit(False) if value is None else F.coalesce(c < F.lit(value), F.lit(True))
        if self.nulls_last:
            return F.lit(False) if value is None else F.coalesce(c > F.lit(value), F.lit(True))
        return c.isNotNull() if value is None else F.coalesce(c > F.lit(value), F.lit(False))


def asc(column: str, nulls_last: bool = False) -> Key:
    return Key(column, nulls_last=nulls_last)


def desc(column: str) -> Key:
    return Key(column, descending=True)


def sort_columns(keys: Sequence[Key]) -> list[Column]:
    return [k.sort() for k in keys]


def nulls_last(columns: Sequence[str]) -> list[Column]:
    """Fields of a struct whose smallest value has NULL behind all values of each column."""
    return [f for c in columns for f in (F.col(c).isNull().alias(f"no_{c}"), F.col(c))]


def after(keys: Sequence[Key], row: Mapping[str, Any], inclusive: bool) -> Column:
    """Whether a row sorts after ``row`` (or, if ``inclusive``, is level with it)."""
    condition = F.lit(inclusive)
    for key in reversed(keys):
        value = row[key.column]
        condition = key.strictly_after(value) | (F.col(key.column).eqNullSafe(F.lit(value)) & condition)
    return condition
