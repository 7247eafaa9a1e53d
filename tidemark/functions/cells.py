"""Cell ids: a latitude/longitude grid, and bit work on hexagon (H3) ids.

The grid id is a long: row * COLUMNS + column, cells ``size`` degrees wide. The
H3 index itself comes with the feed.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the 64-bit hexagon id layout: resolution in bits 52-55,
# then 15 three-bit digits, unused digits all ones.
RESOLUTION_SHIFT = 52
RESOLUTION_MASK = 0xF
DIGIT_BITS = 3
FINEST = 15


def grid_columns(size: float) -> int:
    return round(360.0 / size)


def grid_cell(lat: Column, lon: Column, size: float) -> Column:
    row = F.floor((lat + 90.0) / F.lit(size))
    col = F.floor((lon + 180.0) / F.lit(size))
    return (row * F.lit(grid_columns(size)) + col).cast("long")


def grid_centre(cell: Column, size: float) -> tuple[Column, Column]:
    """(latitude, longitude) of a grid cell's centre."""
    n = F.lit(grid_columns(size))
    row, col = F.floor(cell / n), cell % n
    return (row + 0.5) * F.lit(size) - 90.0, (col + 0.5) * F.lit(size) - 180.0


def cell_parent(cell: Column, resolution: int) -> Column:
    """Ancestor of a hexagon id at a coarser ``resolution``; null if the id is coarser already."""
    unused = (1 << (DIGIT_BITS * (FINEST - resolution))) - 1
    keep_mask = ~(RESOLUTION_MASK << RESOLUTION_SHIFT)
    moved = cell.bitwiseAND(F.lit(keep_mask)).bitwiseOR(F.lit(resolution << RESOLUTION_SHIFT))
    return F.when(cell_resolution(cell) >= resolution, moved.bitwiseOR(F.lit(unused)))


def cell_resolution(cell: Column) -> Column:
    return F.shiftright(cell, RESOLUTION_SHIFT).bitwiseAND(F.lit(RESOLUTION_MASK)).cast("int")


def cell_text(cell: Column) -> Column:
    """Lower-case hexadecimal form of a cell id."""
    return F.lower(F.hex(cell))


def cell_number(text: Column) -> Column:
    return F.conv(text, 16, 10).cast("long")


# Quad cells: the square [-180, 180) x [-180, 180) of degrees halved ``level`` times each way. The id holds the bits of row
# and column in turns behind a leading 1, so that children of a cell are neighbours and the parent is a shift.
QUAD_FINEST = 29
_EVEN = 0x5555555555555555


def _spread(n: Column) -> Column:
    """The bits of a number, each moved to the even places: its binary digits, read in base 4."""
    return F.conv(F.bin(n), 4, 10).cast("long")


def _gather(n: Column) -> Column:
    """The even bits of a number, moved together again."""
    return F.conv(F.conv(n.bitwiseAND(F.lit(_EVEN)).cast("string"), 10, 4), 2, 10).cast("long")


def quad_side(level: Column) -> Column:
    """Side of a quad cell in degrees."""
    return F.lit(360.0) * F.pow(F.lit(2.0), -level)


def quad_step(degrees: Column, level: Column) -> Column:
    """Row of a latitude, or column of a longitude."""
    return F.floor((degrees + 180.0) / quad_side(level)).cast("long")


def quad_id(row: Column, col: Column, level: int | Column) -> Column:
    level = F.lit(level) if isinstance(level, int) else level
    bits = F.shiftleft(_spread(row.cast("long")), 1).bitwiseOR(_spread(col.cast("long")))
    return bits + F.pow(F.lit(4.0), level).cast("long")


def quad_cell(lat: Column, lon: Column, level: int) -> Column:
    """Quad cell of a point; null unless -180 <= lat, lon < 180."""
    fits = lat.between(-180.0, 180.0) & lon.between(-180.0, 180.0) & (lat < 180.0) & (lon < 180.0)
    return F.when(fits, quad_id(quad_step(lat, F.lit(level)), quad_step(lon, F.lit(level)), level))


def quad_level(cell: Column) -> Column:
    return F.floor((F.length(F.bin(cell)) - 1) / 2).cast("int")


def quad_parent(cell: Column, level: int) -> Column:
    """Ancestor at a coarser ``level``; null if the cell is coarser already."""
    up = quad_level(cell) - level
    return F.when(up >= 0, F.call_function("shiftright", cell, 2 * up))


def quad_row_col(cell: Column) -> tuple[Column, Column]:
    bits = cell - F.pow(F.lit(4.0), quad_level(cell)).cast("long")
    return _gather(F.shiftright(bits, 1)), _gather(bits)


def quad_neighbours(cell: Column) -> Column:
    """The up to eight cells of the same level around a cell; none beyond the square's rim, which columns wrap around."""
    level, (row, col) = quad_level(cell), quad_row_col(cell)
    n = F.pow(F.lit(2.0), level).cast("long")
    steps = [(r, c) for r in (-1, 0, 1) for c in (-1, 0, 1) if (r, c) != (0, 0)]
    around = [F.when((row + r >= 0) & (row + r < n), quad_id(row + r, F.pmod(col + c, n), level)) for r, c in steps]
    return F.array_sort(F.array_except(F.array_distinct(F.array_compact(F.array(*around))), F.array(cell)))
