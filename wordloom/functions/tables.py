"""Evaluators of rule tables: the tables hold names, values and their order; conditions come by name."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F


def first_of(values: Mapping[str, object], holds: Mapping[str, Column], otherwise: object) -> Column:
    """The value of the first row of a table whose condition holds."""
    out: Column | None = None
    for name, value in values.items():
        value = value if isinstance(value, Column) else F.lit(value)
        out = F.when(holds[name], value) if out is None else out.when(holds[name], value)
    return out.otherwise(otherwise)


def sum_of(values: Mapping[str, float], holds: Mapping[str, Column]) -> Column:
    """The values of all rows of a table whose conditions hold, added up."""
    out = F.lit(0.0)
    for name, value in values.items():
        out = out + F.when(holds[name], value).otherwise(0.0)
    return out


def looked_up(table: Mapping[str, object], key: Column) -> Column:
    """The value that a table has for a key; null for none."""
    return F.try_element_at(F.create_map(*[F.lit(x) for row in table.items() for x in row]), key)
