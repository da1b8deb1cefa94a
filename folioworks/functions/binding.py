"""Naming an intermediate value inside an expression."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` applied to ``value``, which is evaluated once however often ``body`` uses it.

    Inside higher-order functions Spark does not share common subexpressions; binding the value to a lambda variable
    over a one-element array does.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def free_names(columns: Sequence[str], *names: str) -> list[str]:
    """The given names, with underscores in front where ``columns`` have one already, in whatever case."""
    taken = {c.lower() for c in columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def computed_once(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns that stay computed: no later filter on them moves below and computes them again.

    Catalyst pushes a filter through a projection by copying the expressions into it, which for a parsed body means
    parsing it once more per mention. It does not push through an outer explode.
    """
    values = F.struct(*(column.alias(name) for name, column in columns.items()))
    (holder,) = free_names([*df.columns, *columns], "_values")
    return df.select("*", F.explode_outer(F.array(values)).alias(holder)).select(*df.columns, f"{holder}.*")
