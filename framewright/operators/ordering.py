"""Numbers by order."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def dense_number(df: DataFrame, by: str, name: str) -> DataFrame:
    """Adds the place of a row's value among the distinct values, from 0. The distinct values are few: lines of a table of bins."""
    values = df.select(by).distinct().withColumn(name, (F.row_number().over(Window.orderBy(by)) - 1).cast("int"))
    return df.join(values, by)
