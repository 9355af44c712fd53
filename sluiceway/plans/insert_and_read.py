"""Insert rows into a table, then read the table back."""

from pyspark.sql import DataFrame, SparkSession

from sluiceway.sinks.tables import InsertReport, insert_rows
from sluiceway.sources.tables import scan_table


def insert_and_read(
    spark: SparkSession, table: str, rows: DataFrame, skip_refused: bool = False
) -> tuple[InsertReport, DataFrame]:
    """The insert report and, whether or not the rows fitted, all rows of the table.

    If some rows are refused none goes in, or with ``skip_refused`` the others do.
    """
    return insert_rows(rows, table, skip_refused), scan_table(spark, table)
