"""Column steps: how a group of indicators is computed in few window passes.

A *family* is a list of dictionaries from column names to SQL expressions. Those
at even places hold window expressions, those at odd places plain ones over
columns made before. Families are run side by side, place by place, so that all
window expressions of one place share a single pass over the sorted rows. Names
that start with ``_`` are helpers and are dropped at the end.
"""

from collections.abc import Callable, Iterable
from dataclasses import dataclass
from itertools import zip_longest

from pyspark.sql import DataFrame

Family = list[dict[str, str]]


@dataclass(frozen=True)
class Series:
    """Rows of one group in time order, as the window clauses over them."""

    keys: tuple[str, ...]

    @property
    def group(self) -> str:
        return f"OVER (PARTITION BY {', '.join(self.keys)})"

    @property
    def ordered(self) -> str:
        return f"OVER (PARTITION BY {', '.join(self.keys)} ORDER BY time)"

    @property
    def so_far(self) -> str:
        """All rows up to the current one."""
        return self._rows("UNBOUNDED PRECEDING")

    def last(self, n: int) -> str:
        """The current row and the ``n - 1`` before it."""
        return self._rows(f"{n - 1} PRECEDING")

    def lag(self, value: str, back: int = 1) -> str:
        return f"lag({value}, {back}) {self.ordered}"

    def _rows(self, start: str) -> str:
        frame = f"ROWS BETWEEN {start} AND CURRENT ROW"
        return f"OVER (PARTITION BY {', '.join(self.keys)} ORDER BY time {frame})"


def run_families(df: DataFrame, families: Iterable[Family], keep: Iterable[str] = ()) -> DataFrame:
    kept = {*df.columns, *keep}
    for place in zip_longest(*families, fillvalue={}):
        columns = {name: text for part in place for name, text in part.items()}
        if columns:
            df = df.selectExpr("*", *[f"{text} AS {name}" for name, text in columns.items()])
    return df.drop(*[c for c in df.columns if c.startswith("_") and c not in kept])


def _cut(size: int) -> list[tuple[int, int]]:
    """``size`` rows as (block length, rows back) pieces: blocks of 20 rows if they are many, of 5, and one of what is left."""
    pieces, back = [], 0
    for block in (20, 5) if size > 40 else (5,):
        while size - back >= block:
            pieces.append((block, back))
            back += block
    return pieces + ([(size - back, back)] if size > back else [])


def rolling_means(value: str, sizes: Iterable[int], series: Series, name: Callable[[int], str]) -> Family:
    """``name(n)``: the mean of column ``value`` over the last n rows, for every n.

    A sliding frame is summed anew for every row, so a 200-row mean costs 200
    additions per row. Only sums of up to five rows slide; sums of 20 rows are put
    together from four of these, each a ``lag`` away, and longer ones from both.
    Means of up to 40 rows are there after place 3, others after place 5. NULL
    values are skipped; where a window holds nothing else the mean is NULL.
    """
    sizes = list(sizes)
    long = [n for n in sizes if n > 40]

    def total(block: int, back: int = 0) -> str:
        return f"_{value}_sum{block}" + (f"_back{back}" if back else "")

    def count(back: int = 0) -> str:
        return f"_{value}_count" + (f"_back{back}" if back else "")

    def added(pieces: list[tuple[int, int]]) -> str:
        # Rows before the start of the series add nothing.
        return " + ".join(f"coalesce({total(*piece)}, 0D)" for piece in pieces)

    def mean(n: int) -> str:
        # How many values a window holds is exact as a difference of running counts.
        held = f"({count()} - coalesce({count(n)}, 0))"
        return f"CASE WHEN {held} > 0 THEN ({added(_cut(n))}) / {held} END"

    pieces = {piece for n in sizes for piece in _cut(n)} | ({*_cut(20)} if long else set())
    slid = sorted({block for block, _ in pieces if block < 20})
    lagged = sorted(piece for piece in pieces if piece[1])
    steps = [
        {total(block): f"sum({value}) {series.last(block)}" for block in slid} | {count(): f"count({value}) {series.so_far}"},
        {},
        {total(block, back): series.lag(total(block), back) for block, back in lagged if block < 20}
        | {count(n): series.lag(count(), n) for n in sizes},
        {name(n): mean(n) for n in sizes if n not in long},
    ]
    if not long:
        return steps
    steps[3][total(20)] = added(_cut(20))
    return [
        *steps,
        {total(block, back): series.lag(total(block), back) for block, back in lagged if block == 20},
        {name(n): mean(n) for n in long},
    ]
