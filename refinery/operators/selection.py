"""The rows at given places of an order, found by histograms that are refined: nothing is sorted and no row is moved."""

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CELLS = 4096


@dataclass
class _Search:
    """One place of one order: what is known of the row there. ``rank`` counts from 0 among the rows still in question."""

    name: str
    place: int
    rank: int
    low: int = 0
    high: int = 0
    on_key: bool = False
    value: int | None = None
    key: int | None = None

    def width(self) -> int:
        return -(-(self.high - self.low + 1) // CELLS)


def rows_at(df: DataFrame, values: Mapping[str, Column], key: str, places: Sequence[int]) -> dict[str, dict[int, tuple[int | None, int]]]:
    """For each order of ``values``, value and key of the rows at ``places`` (from 1; those beyond the last row are left out).

    Values are integers, missing ones first; ties go by ``key``, an integer that is different in every row. Each round counts the
    rows of at most ``CELLS`` cells per place, on the tasks that hold them, and goes on inside the cell that holds the place, so
    there are as many rounds as digits to the base ``CELLS``: six for values and keys of 36 bits. ``df`` is read once a round.
    """
    total, searches = _begin(df, values, key, places)
    if not total:
        return {name: {} for name in values}
    key_range = df.agg(F.min(key), F.max(key)).first()
    for search in searches:
        if search.on_key:
            search.low, search.high = key_range
    while open_ones := [search for search in searches if search.key is None]:
        counts = _counts(df, values, key, open_ones)
        for place, search in enumerate(open_ones):
            _refine(search, counts.get(place, {}), key_range)
    return {name: {s.place: (s.value, s.key) for s in searches if s.name == name} for name in values}


def _begin(df, values, key, places) -> tuple[int, list[_Search]]:
    wanted = [part for value in values.values() for part in (F.count(value), F.min(value), F.max(value))]
    total, *found = df.agg(F.count(F.lit(1)), *wanted).first()
    searches = []
    for i, name in enumerate(values):
        known, low, high = found[3 * i : 3 * i + 3]
        for place in sorted(set(places)):
            if not 1 <= place <= total:
                continue
            missing = total - known
            if place <= missing:
                searches.append(_Search(name, place, place - 1, on_key=True))
            else:
                searches.append(_Search(name, place, place - 1 - missing, low, high))
    return total, searches


def _counts(df, values, key, searches) -> dict[int, dict[int, int]]:
    """Rows in each cell of each search: at most ``CELLS`` numbers per search come to the driver."""
    cells = []
    for search in searches:
        number = F.col(key) if search.on_key else values[search.name]
        inside = number.between(search.low, search.high)
        if search.on_key:
            inside = inside & values[search.name].eqNullSafe(F.lit(search.value))
        cell = _whole_quotient(number - search.low, search.width())
        cells.append(F.when(inside, F.struct(F.lit(len(cells)).alias("search"), cell.alias("cell"))))
    rows = df.select(F.explode(F.array_compact(F.array(*cells))).alias("c")).groupBy("c.search", "c.cell").agg(F.count(F.lit(1)).alias("n"))
    found: dict[int, dict[int, int]] = {}
    for row in rows.collect():
        found.setdefault(row["search"], {})[row["cell"]] = row["n"]
    return found


def _whole_quotient(number: Column, width: int) -> Column:
    """In whole numbers: a double does not hold 64 bits."""
    return F.call_function("div", number.cast("bigint"), F.lit(width).cast("bigint"))


def _refine(search: _Search, counts: dict[int, int], key_range: tuple[int, int]) -> None:
    before = 0
    for cell in sorted(counts):
        if before + counts[cell] > search.rank:
            break
        before += counts[cell]
    else:
        raise ValueError(f"the rows have changed since they were counted: no row at place {search.place}")
    search.rank -= before
    width = search.width()
    search.low, search.high = search.low + cell * width, min(search.high, search.low + (cell + 1) * width - 1)
    if search.low < search.high:
        return
    if search.on_key:
        search.key = search.low
    else:
        search.value, search.on_key = search.low, True
        search.low, search.high = key_range
