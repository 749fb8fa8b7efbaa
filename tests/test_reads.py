from datetime import date

import pytest
from pyspark.errors import AnalysisException, ParseException

from series import START, closes, frame
from tickloom.plans import catalog, reads

AS_OF = date(2024, 1, 3)


@pytest.fixture
def bars(spark):
    return frame(spark, closes("a", [float(i) for i in range(12)], step=21_600)
                 + closes("b", [50.0, 51.0], start=START + 86_400))


def values(df):
    return [r.close for r in df.collect()]


def test_latest_and_fallback(bars):
    out = reads.latest(bars, ["a", "b"], AS_OF, 2)
    assert sorted((r.symbol, r.close) for r in out.collect()) == [("a", 10.0), ("a", 11.0), ("b", 50.0), ("b", 51.0)]
    assert values(reads.latest(bars, ["b"], date(2024, 1, 9))) == []
    assert values(reads.latest(bars, ["a"], AS_OF)) == [11.0]


def test_day_and_range(bars):
    assert values(reads.day_bars(bars, "a", date(2024, 1, 2), 3)) == [7.0, 6.0, 5.0]
    assert values(reads.range_bars(bars, "a", date(2024, 1, 1), date(2024, 1, 2))) == [
        float(i) for i in range(7, -1, -1)]
    assert values(reads.range_bars(bars, "a", date(2024, 1, 1), date(2024, 1, 2), limit=2)) == [7.0, 6.0]
    assert len(values(reads.range_bars(bars, "a", date(2024, 1, 1), AS_OF))) == 12
    plan = reads.range_bars(bars, "a", AS_OF, AS_OF, limit=5)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan


def test_multi_symbol(bars):
    out = reads.multi_symbol(bars, ["a", "b"], date(2024, 1, 2))
    assert sorted(values(out)) == [4.0, 5.0, 6.0, 7.0, 50.0, 51.0]


@pytest.mark.parametrize("name, first, last", [
    ("latest", "2024-01-03", "2024-01-03"), ("Now", "2024-01-03", "2024-01-03"),
    ("yesterday", "2024-01-02", "2024-01-02"), ("recent", "2024-01-01", "2024-01-03"),
    ("last week", "2023-12-28", "2024-01-03"), ("this month", "2024-01-01", "2024-01-03"),
])
def test_named_ranges(name, first, last):
    assert [str(d) for d in reads.resolve_range(name, AS_OF)] == [first, last]


def test_unknown_range():
    with pytest.raises(ValueError):
        reads.resolve_range("someday", AS_OF)


def test_sql_reads_only(spark, bars):
    bars.createOrReplaceTempView("bars_for_sql")
    assert reads.run_sql(spark, "SELECT max(close) AS m FROM bars_for_sql;").first().m == 51.0
    assert reads.run_sql(spark, "WITH x AS (SELECT 1 AS one) SELECT * FROM x").first().one == 1
    for text in ("DROP VIEW bars_for_sql", "CREATE TABLE t (a INT)", "INSERT INTO bars_for_sql VALUES (1)",
                 "SELECT 1) ; DROP VIEW bars_for_sql; SELECT (1", "WITH x AS (SELECT 1) INSERT INTO t SELECT * FROM x"):
        with pytest.raises(ParseException):
            reads.run_sql(spark, text)
    assert spark.catalog.tableExists("bars_for_sql")


def test_sql_stays_within_the_views(spark, bars, tmp_path):
    bars.createOrReplaceTempView("bars_for_sql")
    secret = tmp_path / "secret.txt"
    secret.write_text("hidden")
    bars.write.mode("overwrite").option("path", str(tmp_path / "table")).saveAsTable("bars_as_table")
    for text in (
        "SELECT reflect('java.lang.System', 'setProperty', 'reached', 'yes')",
        "SELECT java_method('java.lang.System', 'lineSeparator')",
        "SELECT try_reflect('java.lang.System', 'lineSeparator')",
        "SELECT upper(reflect('java.lang.System', 'lineSeparator')) AS x FROM bars_for_sql WHERE close > 1",
        f"SELECT * FROM text.`{secret}`",
        f"SELECT * FROM bars_for_sql WHERE symbol IN (SELECT value FROM text.`{secret}`)",
        f"SELECT (SELECT max(value) FROM text.`{secret}`) AS x",
        f"WITH x AS (SELECT * FROM text.`{secret}`) SELECT * FROM x",
        "SELECT * FROM bars_as_table",
    ):
        with pytest.raises((ValueError, AnalysisException)):
            reads.run_sql(spark, text)
    assert spark._jvm.java.lang.System.getProperty("reached") is None
    for text, rows in (
        ("SELECT symbol, avg(close) AS m FROM bars_for_sql GROUP BY symbol", 2),
        ("SELECT a.time FROM bars_for_sql a JOIN bars_for_sql b ON a.time = b.time AND a.symbol < b.symbol", 1),
        ("SELECT * FROM bars_for_sql WHERE close = (SELECT max(close) FROM bars_for_sql)", 1),
        ("SELECT * FROM VALUES (1), (2) AS t(x)", 2), ("SELECT id FROM range(3)", 3),
        ("SELECT close, row_number() OVER (ORDER BY close) AS n FROM bars_for_sql WHERE symbol IN (SELECT min(symbol) FROM bars_for_sql)", 12),
        ("WITH x AS (SELECT * FROM bars_for_sql) SELECT * FROM x UNION ALL SELECT * FROM x", 28),
    ):
        assert reads.run_sql(spark, text).count() == rows
    spark.sql("DROP TABLE bars_as_table")


def test_catalog(spark, bars):
    bars.createOrReplaceTempView("bars_catalog")
    assert "bars_catalog" in [r.table_name for r in catalog.list_tables(spark).collect()]
    rows = catalog.describe_table(spark, "bars_catalog").orderBy("position").collect()
    assert [(r.column_name, r.type, r.kind) for r in rows[:4]] == [
        ("symbol", "string", "PARTITION KEY"), ("day", "date", "PARTITION KEY"),
        ("time", "bigint", "CLUSTERING KEY"), ("open", "double", None)]
    assert catalog.describe_table(spark, "no_such_table").count() == 0
    for i in range(6):
        bars.createOrReplaceTempView(f"zz_{i}")
    lines = [(r.section, r.text) for r in catalog.database_overview(spark).collect()]
    assert lines[0][0] == "tables" and lines[-1][0] == "more"
    assert ("bars_catalog", "symbol string (PARTITION KEY)") in lines
    for i in range(6):
        spark.catalog.dropTempView(f"zz_{i}")
