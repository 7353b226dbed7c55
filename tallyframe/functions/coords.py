"""``'x,y'`` coordinates and rectangular regions."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce
from operator import or_
from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F


class Box(NamedTuple):
    """A region; all four bounds belong to it."""

    x_min: int
    x_max: int
    y_min: int
    y_max: int


def split_coordinate(coordinate: str | Column = "coordinate") -> tuple[Column, Column]:
    """Integer x and y; NULL where the text is not two integers."""
    coordinate = F.col(coordinate) if isinstance(coordinate, str) else coordinate
    x, y = (F.split_part(coordinate, F.lit(","), F.lit(n)).try_cast("int") for n in (1, 2))
    return x, y


def in_any_box(x: Column, y: Column, boxes: Iterable[Box]) -> Column:
    """True inside at least one box; an empty list of boxes holds nothing."""
    inside = [x.between(b[0], b[1]) & y.between(b[2], b[3]) for b in boxes]
    return reduce(or_, inside, F.lit(False))
