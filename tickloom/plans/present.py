"""Result shape for reports: text days and rounded numbers."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.functions.numbers import rounded

# Means of two-decimal prices over up to 200 rows have no ties at nine decimals,
# so results do not depend on the order in which floats were added.
DECIMALS = 9


def present(df: DataFrame, decimals: int = DECIMALS) -> DataFrame:
    def shape(field: T.StructField):
        column = F.col(field.name)
        if isinstance(field.dataType, T.DoubleType):
            column = rounded(column, decimals)
        elif isinstance(field.dataType, T.DateType):
            column = F.date_format(column, "yyyy-MM-dd")
        return column.alias(field.name)

    return df.select(*[shape(f) for f in df.schema.fields])
