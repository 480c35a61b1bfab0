"""Text helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def is_blank(c: Column) -> Column:
    """NULL, empty or only white space."""
    return c.isNull() | (F.trim(c.cast("string")) == "")


def contains_ignoring_case(c: Column, term: str) -> Column:
    """Plain substring match: characters such as ``.`` or ``*`` in the term stand for themselves."""
    return F.contains(F.lower(c.cast("string")), F.lit(term.lower()))


def title_case(c: Column) -> Column:
    """``home_appliances`` to ``Home Appliances``."""
    return F.initcap(F.replace(c, F.lit("_"), F.lit(" ")))
