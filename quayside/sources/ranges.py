"""Ranges of a split column that hold about equally many rows.

Keys are rarely even: numbers are reserved, deleted, or start anew far above. Ranges of one
width then leave one reader with most of the rows. Here the database counts its rows per cell
of a grid, cells that hold more than a reader's share are counted again on a finer grid, and
neighbouring cells are put together. Only counts come to the driver: CELLS of the first grid,
and FINER for each reader's share on a finer one.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

# Cells of the first grid, and those that a cell is cut into. Powers of two, so grids nest.
CELLS = 1024
FINER = 32
# Stretches of the column asked about in one query.
STRETCHES = 200

# (start, rows) of the cells that hold any, for a width of cells and the stretches [from, to)
# that are wanted; none stands for the whole column.
Count = Callable[[int, list[tuple[int, int]] | None], Iterable[tuple[int, int]]]


def even_cuts(count: Count, low: int, high: int, parts: int, rows_per_part: int | None = None) -> list[int]:
    """Values that cut the column into ranges with about equally many rows, in order.

    There are about `parts` ranges, or as many more as `rows_per_part` needs. A range holds less
    than twice its share of rows unless a single value holds more.
    """
    width = 1
    while (high - low) // width >= CELLS:
        width *= 2
    cells = dict(count(width, None))
    total = sum(cells.values())
    parts = max(parts, -(-total // rows_per_part) if rows_per_part else 1)
    share = max(1, -(-total // parts))
    done: dict[int, int] = {}
    while heavy := sorted(start for start, n in cells.items() if n > share and width > 1):
        done |= {start: n for start, n in cells.items() if n <= share}
        stretches = joined([(start, start + width) for start in heavy])
        width = max(1, width // FINER)
        cells = {}
        for first in range(0, len(stretches), STRETCHES):
            cells |= dict(count(width, stretches[first : first + STRETCHES]))
    cuts, filled = [], 0
    for start, n in sorted((done | cells).items()):
        if filled and filled + n > share:
            cuts.append(start)
            filled = 0
        filled += n
    return cuts


def joined(stretches: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Neighbouring stretches as one."""
    out: list[tuple[int, int]] = []
    for start, stop in stretches:
        if out and out[-1][1] == start:
            start = out.pop()[0]
        out.append((start, stop))
    return out


def predicates(column: str, cuts: list[int]) -> list[str]:
    """SQL conditions of the ranges between cuts; each row meets one, nulls the first."""
    if not cuts:
        return ["1 = 1"]
    inner = [f"{column} >= {a} AND {column} < {b}" for a, b in zip(cuts, cuts[1:])]
    return [f"{column} < {cuts[0]} OR {column} IS NULL", *inner, f"{column} >= {cuts[-1]}"]
