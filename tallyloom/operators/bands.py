"""Band joins: rows that are equal in some columns and near each other in others."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _cell(value: Column, width: int | Decimal) -> Column:
    return F.floor(value / F.lit(width)).cast("long")


def near_pairs(classes: DataFrame, equal: Sequence[str], bands: Mapping[str, int | Decimal], number: str) -> DataFrame:
    """Pairs of rows that agree in ``equal`` and lie within each band's width, bounds included: (left, right) structs.

    ``number`` is a unique number of each row; the lesser one of a pair is on the left and a row
    never meets itself. Band columns are whole numbers or decimals, so nothing is rounded. Rows
    with a NULL in a compared column have no partner.

    The bands cut the plane into cells as wide as themselves, so partners lie in neighbouring
    cells: one side is laid into its own cell and all around it, and both meet by equality. A key
    with very many rows is spread over as many groups as it has cells. Equal rows should be
    gathered into one class before, as their pairs would be every pair of a cell.
    """
    compared = [*equal, *bands]
    known = classes
    for name in compared:
        known = known.filter(F.col(name).isNotNull())
    row = F.struct(*classes.columns)
    cells = {f"_cell_{k}": _cell(F.col(name), width) for k, (name, width) in enumerate(bands.items())}
    keys = {f"_key_{k}": F.col(name) for k, name in enumerate(equal)}
    here = known.select(*[c.alias(n) for n, c in {**keys, **cells}.items()], row.alias("right"))
    around = known.select(*[c.alias(n) for n, c in {**keys, **cells}.items()], row.alias("left"))
    for name in cells:
        around = around.withColumn(name, F.explode(F.array(*[F.col(name) + step for step in (-1, 0, 1)])))
    pairs = around.join(here, [*keys, *cells]).filter(F.col(f"left.{number}") < F.col(f"right.{number}"))
    for name, width in bands.items():
        pairs = pairs.filter(F.abs(F.col(f"left.{name}") - F.col(f"right.{name}")) <= F.lit(width))
    return pairs.select("left", "right")
