"""Bind an intermediate result inside one expression."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once.

    Projection collapsing copies a column expression to every place that uses
    it, also into lambda bodies that run per array element. A lambda variable
    is never copied, so an expensive value is bound to one.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def hold(df: DataFrame, **columns: Column) -> DataFrame:
    """``df`` with new columns that are evaluated once per row, however often they are used.

    A plain new column is copied by the optimizer into the expressions that use it, and
    those that run lambdas evaluate every copy. A generator of one row keeps its place.
    """
    row = F.struct(*[value.alias(name) for name, value in columns.items()])
    return df.select("*", F.inline(F.array(row)))


def first_truthy(*columns: Column) -> Column:
    """First value that is neither null nor the empty string."""
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in columns])


def lookup(table: dict[str, str], key: Column, default: str) -> Column:
    """Value of a small fixed table, ``default`` for unknown keys."""
    pairs = [F.lit(x) for item in table.items() for x in item]
    return F.coalesce(F.element_at(F.create_map(*pairs), key), F.lit(default))


def keep_where(df: DataFrame, condition: Column) -> DataFrame:
    """``df.filter(condition)``, tested on the columns as they stand.

    The optimizer moves a plain filter below the projection that computes its
    column, and the column is then computed twice. That is right for cheap
    columns; for a cleaned text it doubles the work. A generator of one or no
    rows keeps its place.
    """
    passed = F.when(condition, F.array(F.lit(True)))
    return df.select("*", F.explode(passed).alias("_passed")).drop("_passed")


def non_empty(items: Column) -> Column:
    """An array to explode, null when it is empty.

    For a bare array column the optimizer adds a filter on its size and moves
    that down to the scan, which computes the array once more.
    """
    return F.when(F.size(items) > 0, items)
