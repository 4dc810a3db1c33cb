"""Records laid out along a space-filling curve, so that a bounding box reads a few ranges of them."""

from __future__ import annotations

import heapq
import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stackroom.operators.search import check_bbox, geo_bbox

# Name of the cell column, bits per side of the grid, and ranges that a box is covered by at most.
CELL, BITS, RANGES = "geo_cell", 16, 64
SIDE = 1 << BITS


def _step(value: float, low: float, span: float) -> int:
    """Row or column of the grid that holds a value; those outside belong to the outermost."""
    return max(0, min(SIDE - 1, math.floor((value - low) / span * SIDE)))


def _step_column(value: Column, low: float, span: float) -> Column:
    inside = F.greatest(F.lit(0.0), F.least(F.lit(float(SIDE - 1)), (value.cast("double") - low) / span * SIDE))
    # NaN is greater than every number.
    return F.when(value.isNotNull(), F.when(F.isnan(value), F.lit(SIDE - 1)).otherwise(F.floor(inside)).cast("long"))


def _spread(x: Column) -> Column:
    """The bits of a number of 16 bits, with a gap behind each."""
    for shift, mask in ((8, 0x00FF00FF), (4, 0x0F0F0F0F), (2, 0x33333333), (1, 0x55555555)):
        x = (x.bitwiseOR(F.shiftleft(x, shift))).bitwiseAND(F.lit(mask).cast("long"))
    return x


def geo_cell(lat: Column, lon: Column) -> Column:
    """Number of the grid cell of a place: the bits of its row and its column in turn; null without both."""
    return _spread(_step_column(lat, -90.0, 180.0)).bitwiseOR(F.shiftleft(_spread(_step_column(lon, -180.0, 360.0)), 1))


def _ranges(rows: tuple[int, int], columns: tuple[int, int], most: int) -> list[tuple[int, int]]:
    """Ranges of cell numbers that cover a block of the grid; the largest squares that lie partly inside are divided first."""

    def kind(level: int, row: int, column: int) -> str:
        size = SIDE >> level
        top, left = row * size, column * size
        if top > rows[1] or top + size - 1 < rows[0] or left > columns[1] or left + size - 1 < columns[0]:
            return "out"
        inside = rows[0] <= top and top + size - 1 <= rows[1] and columns[0] <= left and left + size - 1 <= columns[1]
        return "in" if inside else "part"

    whole: list[tuple[int, int]] = []
    open_squares = [(0, 0, 0, 0)]
    while open_squares and len(whole) + len(open_squares) < most:
        level, first, row, column = heapq.heappop(open_squares)
        if (state := kind(level, row, column)) == "out":
            continue
        if state == "in" or level == BITS:
            whole.append((level, first))
            continue
        part = 1 << 2 * (BITS - level - 1)
        for quarter in range(4):
            child = (level + 1, first + quarter * part, row * 2 + (quarter & 1), column * 2 + (quarter >> 1))
            if kind(*child[:1], *child[2:]) != "out":
                heapq.heappush(open_squares, child)
    squares = sorted([(first, first + (1 << 2 * (BITS - level)) - 1) for level, first in [*whole, *[(s[0], s[1]) for s in open_squares]]])
    merged: list[tuple[int, int]] = []
    for low, high in squares:
        if merged and merged[-1][1] + 1 >= low:
            merged[-1] = (merged[-1][0], max(high, merged[-1][1]))
        else:
            merged.append((low, high))
    return merged


def box_ranges(north: float, west: float, south: float, east: float, most: int = RANGES) -> list[tuple[int, int]]:
    """Ranges of cell numbers that hold every place of a box; a box with west > east crosses the antimeridian."""
    check_bbox(north, west, south, east)
    rows = (_step(south, -90.0, 180.0), _step(north, -90.0, 180.0))
    sides = [(west, east)] if west <= east else [(west, 180.0), (-180.0, east)]
    return sorted(r for a, b in sides for r in _ranges(rows, (_step(a, -180.0, 360.0), _step(b, -180.0, 360.0)), most // len(sides)))


def write_by_place(records: DataFrame, path: str, lat: str = "lat", lon: str = "lon", files: int | None = None) -> None:
    """Write records in the order of their cells, so that files and row groups hold near places. Records without a place stand first."""
    celled = records.withColumn(CELL, geo_cell(F.col(lat), F.col(lon)))
    dealt = celled.repartitionByRange(CELL, lat, lon) if files is None else celled.repartitionByRange(files, CELL, lat, lon)
    dealt.sortWithinPartitions(CELL).write.parquet(path)


def bbox_of_layout(
    records: DataFrame, north: float, west: float, south: float, east: float, lat: str = "lat", lon: str = "lon"
) -> DataFrame:
    """Rows inside the box, out of records written by :func:`write_by_place`: only row groups of its cells are read."""
    ranges = [F.col(CELL).between(a, b) for a, b in box_ranges(north, west, south, east)]
    near = records.filter(reduce(lambda x, y: x | y, ranges))
    return geo_bbox(near, north, west, south, east, lat, lon).drop(CELL)
