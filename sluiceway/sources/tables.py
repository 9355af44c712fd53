"""Catalog tables, and folders of routed rows."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def scan_table(spark: SparkSession, table: str) -> DataFrame:
    """All rows a table has now. The name is passed as an identifier, never pasted into SQL.

    A stream writes from a session of its own, so the file list this session may have kept
    from an earlier read is dropped first.
    """
    spark.catalog.refreshTable(table)
    return spark.sql("SELECT * FROM IDENTIFIER(:table)", args={"table": table})


def read_routes(spark: SparkSession, folder: str, rows: T.StructType) -> DataFrame:
    """The rows of a folder that :func:`sluiceway.streaming.writers.write_routes` fills.

    ``rows`` is their schema, to which ``route``, ``query_id`` and ``batch_id`` are added. A
    folder to which no row was routed is empty. A filter on ``route`` reads that route only.
    """
    schema = T.StructType(list(rows)).add("route", T.StringType())
    schema = schema.add("query_id", T.StringType()).add("batch_id", T.LongType())
    return spark.read.schema(schema).parquet(folder)
