"""Row windows over long series, cut into bounded pieces.

A window partitioned by symbol puts a symbol's whole history into one task.
Here a series is cut into time spans, each of which holds a bounded number of
bars (bars of a symbol are ``width_seconds`` apart at least), and a row window
that looks at most ``reach`` rows back is computed in two places:

* in the span, for rows with at least ``reach`` rows before them there, and for
  all rows of a symbol's first span;
* over the *edges*, for the first ``reach`` rows of every later span. Edges are
  the first and last ``reach`` rows of every span. Rows before a span's head are
  the last rows of earlier spans, and a span with fewer rows than ``reach`` is
  all edge, so a head row has the same ``reach`` rows before it in the edges as
  in the whole series.

The edges of a symbol are at most ``2 * reach`` rows per span, whatever the
number of bars. Both places read one and the same shuffle by (symbol, span).
"""

from collections.abc import Callable, Iterable
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.operators.rolling import Family, Series, run_families
from tickloom.session import settle


@dataclass(frozen=True)
class Spans:
    """How series are cut: ``rows_per_span`` bars of ``width_seconds`` at most.

    A span shorter than twice the look-back would be all edge, so windows refuse
    it unless ``short`` allows it, for tests. At 40 times the look-back 5 % of the
    rows are edge rows.
    """

    width_seconds: int = 60
    rows_per_span: int = 43_200
    short: bool = False

    @property
    def seconds(self) -> int:
        return self.width_seconds * self.rows_per_span

    def longer(self, times: int) -> "Spans":
        return replace(self, rows_per_span=self.rows_per_span * times)

    def check(self, reach: int) -> None:
        if self.rows_per_span < 2 * reach and not self.short:
            raise ValueError(f"spans of {self.rows_per_span} rows are shorter than twice the look-back of {reach} rows")

    def start(self) -> Column:
        """Epoch second at which the span of a bar's ``time`` starts."""
        return F.col("time") - F.pmod(F.col("time"), F.lit(self.seconds).cast("bigint"))


def with_neighbours(facts: DataFrame) -> DataFrame:
    """Mark the first and the last span of each symbol; ``facts`` has one row per span."""
    by_span = Window.partitionBy("symbol").orderBy("_span")
    return facts.withColumns({
        "_first": F.lag("_span").over(by_span).isNull(),
        "_last": F.lead("_span").over(by_span).isNull(),
    })


def span_facts(
    bars: DataFrame,
    reach: int,
    spans: Spans,
    families: Iterable[Family] = (),
    aggregates: Iterable[Column] = (),
) -> DataFrame:
    """One row per (symbol, span): its neighbours, where its edges lie, and
    ``aggregates`` over its bars and the columns of ``families``.

    Reads as few columns of the bars as these need. Fails where a span holds more
    bars than ``rows_per_span``: bars are then closer than ``width_seconds``.
    """
    spans.check(reach)
    piece = Series(("symbol", "_span"))
    edges = [{"_pos": f"row_number() {piece.ordered}", "_tail": piece.lag("time", reach - 1)}]
    placed = run_families(bars.withColumn("_span", spans.start()), [edges, *families], keep=["_pos", "_tail"])
    facts = placed.groupBy("symbol", "_span").agg(
        F.max(F.when(F.col("_pos") <= reach, F.col("time"))).alias("_head_to"),
        F.coalesce(F.max_by("_tail", "time"), F.min("time")).alias("_tail_from"),
        F.max("_pos").alias("_bars"),
        *aggregates,
    )
    too_many = F.raise_error(F.concat(
        F.lit(f"bars are closer than the {spans.width_seconds} seconds that spans are cut for: symbol "), "symbol",
        F.lit(" has "), F.col("_bars").cast("string"), F.lit(" in one span")))
    tail = F.when(F.col("_bars") > spans.rows_per_span, too_many.cast("bigint")).otherwise(F.col("_tail_from"))
    return with_neighbours(facts.withColumn("_tail_from", tail).drop("_bars"))


def over_spans(
    bars: DataFrame,
    families: Callable[[Series], list[Family]],
    reach: int,
    spans: Spans,
    facts: DataFrame | None = None,
    per_span: Callable[[Series], list[Family]] = lambda piece: [],
    work: str | None = None,
) -> DataFrame:
    """Compute ``families`` as if over each symbol's whole series.

    They may only use rows up to ``reach`` before the current one. ``per_span``
    families are computed from each span's start. ``facts`` are those of
    ``span_facts``; further columns in it are carried to every row. They are
    computed here and now, into ``work`` or the shared folder.
    """
    facts = span_facts(bars, reach, spans) if facts is None else facts
    # A row per span, read by both parts below, which need different columns of
    # it: without a table Spark would work the facts out twice.
    facts = settle(facts, "span-facts", work)
    # Facts have one row per span, so the part of them that meets a task's bars
    # is small at any scale: hash that, and shuffle nothing but bars and facts.
    # The join is a left one to keep the bars' shuffle free of added filters.
    cut = (
        bars.withColumn("_span", spans.start())
        .join(facts.hint("shuffle_hash"), ["symbol", "_span"], "left")
    )
    piece, whole = Series(("symbol", "_span")), Series(("symbol",))
    in_head = ~F.col("_first") & (F.col("time") <= F.col("_head_to"))
    in_tail = ~F.col("_last") & (F.col("time") >= F.col("_tail_from"))

    inner = run_families(cut, [*per_span(piece), *families(piece)]).where(~in_head)
    # Few rows are left before anything is sorted here. A head is the start of
    # its span, so per-span columns come out right for it; tails need none.
    edges = run_families(cut.where(in_head | in_tail), per_span(piece))
    heads = run_families(edges, families(whole)).where(in_head)
    return inner.unionByName(heads).drop("_span", "_first", "_last", "_head_to", "_tail_from")
