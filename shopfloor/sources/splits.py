"""Ranges of a key with about as many rows each, for reading a table by several connections."""

from collections.abc import Callable, Sequence

#: Cells that one count query returns at most.
CELLS = 4096

Cell = tuple[int, int, int]
Count = Callable[[int, int, int], dict[int, int]]


def _counted(count: Count, low: int, high: int, cells: int) -> list[Cell]:
    """(low, high, rows) of the cells of equal width between ``low`` and ``high`` (not included) that hold rows."""
    width = max(1, -(-(high - low) // cells))
    return [(low + i * width, min(high, low + (i + 1) * width), n) for i, n in sorted(count(low, high, width).items()) if n]


def histogram(count: Count, low: int, high: int, ranges: int, cells: int = CELLS) -> list[Cell]:
    """Cells from ``low`` to ``high`` (not included), none with more rows than one range should have, if its key differs.

    ``count(low, high, width)`` gives the rows of each cell of that width, by number. Cells with too
    many rows are counted again in finer ones: of these there are fewer than ``ranges`` each time.
    """
    found = _counted(count, low, high, cells)
    most = max(1, sum(n for _, _, n in found) // max(1, ranges))
    done: list[Cell] = []
    while found:
        finer = [(a, b) for a, b, n in found if n > most and b - a > 1]
        done += [(a, b, n) for a, b, n in found if n <= most or b - a == 1]
        found = [cell for a, b in finer for cell in _counted(count, a, b, cells)]
    return sorted(done)


def equi_depth(cells: Sequence[Cell], ranges: int) -> list[int]:
    """Where to cut: at most ``ranges`` - 1 keys, each the first of a new range, by the cells' running sums."""
    total, seen, cuts = sum(n for _, _, n in cells), 0, []
    for low, _, n in cells:
        # A cell goes to the next range if most of it would lie beyond this one's share.
        if seen and len(cuts) < ranges - 1 and (2 * seen + n) * ranges > 2 * total * (len(cuts) + 1):
            cuts.append(low)
        seen += n
    return cuts


def predicates(column: str, cuts: Sequence[int]) -> list[str]:
    """Conditions that together hold for every row once: the ranges between the cuts, open at both ends, and NULL."""
    bounds = [None, *cuts, None]
    out = []
    for low, high in zip(bounds, bounds[1:]):
        parts = [f"{column} >= {low}"] if low is not None else []
        parts += [f"{column} < {high}"] if high is not None else []
        out.append(" AND ".join(parts) or f"{column} IS NOT NULL")
    return [*out, f"{column} IS NULL"]
