"""Reads of a bar table: latest, day, range and multi-symbol reads, and SQL.

"Today" is always the parameter ``as_of``, so a read gives the same rows
whenever it runs.
"""

from collections.abc import Iterable
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tickloom.operators.enrich import newest

# Fixed value: how many bars "the latest" are.
LATEST_LIMIT = 1

ONE_DAY = timedelta(days=1)


def _newest_first(bars: DataFrame, limit: int | None) -> DataFrame:
    ordered = bars.orderBy(F.col("day").desc(), F.col("time").desc(), "symbol")
    return ordered if limit is None else ordered.limit(limit)


def latest(bars: DataFrame, symbols: Iterable[str], as_of: date, n: int = LATEST_LIMIT) -> DataFrame:
    """The newest ``n`` bars of each symbol from ``as_of`` on.

    A symbol without bars from that day on shows those of the day before.
    """
    fallback = F.col("day") < F.lit(as_of)
    recent = (
        bars.where(F.col("symbol").isin(*symbols) & (F.col("day") >= F.lit(as_of - ONE_DAY)))
        .withColumn("_fallback", fallback)
    )
    kept = newest(recent, n, by=("symbol", "_fallback"))
    best = F.min("_fallback").over(Window.partitionBy("symbol"))
    return kept.withColumn("_best", best).where(F.col("_fallback") == F.col("_best")).drop("_fallback", "_best")


def day_bars(bars: DataFrame, symbol: str, day: date, n: int | None = None) -> DataFrame:
    """One symbol's bars of one day, newest first; all of them unless ``n`` is given."""
    return _newest_first(bars.where((F.col("symbol") == symbol) & (F.col("day") == F.lit(day))), n)


def range_bars(bars: DataFrame, symbol: str, start: date, end: date, limit: int | None = None) -> DataFrame:
    """One symbol's bars between two days (both included), newest first; all unless ``limit`` is given."""
    chosen = bars.where((F.col("symbol") == symbol) & F.col("day").between(F.lit(start), F.lit(end)))
    return _newest_first(chosen, limit)


def multi_symbol(bars: DataFrame, symbols: Iterable[str], day: date) -> DataFrame:
    """All bars of several symbols on one day."""
    return bars.where(F.col("symbol").isin(*symbols) & (F.col("day") == F.lit(day)))


def resolve_range(name: str, as_of: date) -> tuple[date, date]:
    """First and last day of a named time range that ends at ``as_of``."""
    match name.strip().lower():
        case "latest" | "current" | "now" | "today":
            return as_of, as_of
        case "yesterday":
            return as_of - ONE_DAY, as_of - ONE_DAY
        case "recent":
            return as_of - 2 * ONE_DAY, as_of
        case "last week":
            return as_of - 6 * ONE_DAY, as_of
        case "this month":
            return as_of.replace(day=1), as_of
    raise ValueError(f"unknown time range: {name!r}")


def named_range(bars: DataFrame, symbol: str, name: str, as_of: date, limit: int | None = None) -> DataFrame:
    return range_bars(bars, symbol, *resolve_range(name, as_of), limit)


# Expressions that reach out of the query.
_REACHING_OUT = ("CallMethodViaReflection", "Reflect", "JavaMethod", "PythonUDF", "PythonUDTF")
# Expressions that hold a query of their own.
_WITH_PLAN = ("ScalarSubquery", "Exists", "ListQuery", "LateralSubquery")
# Sources that hold no stored data, besides the views.
_HARMLESS = ("OneRowRelation", "LocalRelation", "Range", "CTERelationRef", "UnresolvedInlineTable", "ResolvedInlineTable")


def run_sql(spark: SparkSession, sql: str) -> DataFrame:
    """Run one free-form query over the registered temporary views.

    The text is used as a subquery, where the grammar has room for a query
    only: statements that write or define anything do not parse. The analysed
    query may read nothing but views, so no file is named in it and no table,
    and may not call into the JVM or Python.
    """
    text = sql.strip().rstrip(";")
    result = spark.sql(f"SELECT * FROM (\n{text}\n)")
    _refuse(result._jdf.queryExecution().analyzed())
    return result


def _items(sequence):
    return [sequence.apply(i) for i in range(sequence.size())]


def _refuse(plan) -> None:
    """Raise where a plan, its subqueries included, does more than read views."""
    pending = [plan]
    while pending:
        node = pending.pop()
        name = node.getClass().getSimpleName()
        if name == "View":
            # What a view stands for was decided when it was registered.
            if not node.isTempView():
                raise ValueError("only registered views may be read")
            continue
        if any(part in name for part in _REACHING_OUT):
            raise ValueError(f"a query may not call {name}")
        children = _items(node.children())
        if _is_plan(node):
            if not children and name not in _HARMLESS:
                raise ValueError(f"only registered views may be read, not {name}")
            pending += _items(node.expressions()) + _items(node.innerChildren())
        elif name in _WITH_PLAN:
            pending.append(node.plan())
        elif "Subquery" in name and name != "InSubquery":
            raise ValueError(f"a query may not hold {name}")
        pending += children


def _is_plan(node) -> bool:
    return "catalyst.plans" in node.getClass().getName() or "execution" in node.getClass().getName()
