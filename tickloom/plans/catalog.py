"""What tables there are and what their columns mean."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.errors import AnalysisException

from tickloom.schemas import KEY_KINDS

# Fixed value: how many tables an overview describes.
OVERVIEW_TABLES = 5


def list_tables(spark: SparkSession) -> DataFrame:
    """``table_name`` of the tables and views of the current database."""
    return spark.sql("SHOW TABLES").select(F.col("tableName").alias("table_name")).orderBy("table_name")


def describe_table(spark: SparkSession, table: str, key_kinds: dict[str, str] = KEY_KINDS) -> DataFrame:
    """``table_name, position, column_name, type, kind``; no rows for an unknown table."""
    try:
        fields = spark.table(table).schema.fields
    except AnalysisException:
        fields = []
    rows = [(table, i, f.name, f.dataType.simpleString(), key_kinds.get(f.name))
            for i, f in enumerate(fields, start=1)]
    return spark.createDataFrame(
        rows, "table_name string, position int, column_name string, type string, kind string"
    )


def database_overview(spark: SparkSession) -> DataFrame:
    """``section, text``: the table count, the first tables' columns, and how many more there are."""
    names = [row.table_name for row in list_tables(spark).collect()]
    lines = [("tables", f"{len(names)}: {', '.join(names) or '(none)'}")]
    for name in names[:OVERVIEW_TABLES]:
        columns = describe_table(spark, name).collect()
        if not columns:
            lines.append((name, "schema unavailable"))
        for c in columns:
            lines.append((name, f"{c.column_name} {c.type}" + (f" ({c.kind})" if c.kind else "")))
    if len(names) > OVERVIEW_TABLES:
        lines.append(("more", f"... and {len(names) - OVERVIEW_TABLES} more"))
    return spark.createDataFrame(lines, "section string, text string")
