"""Append to catalog tables: never create, match columns by name."""

from dataclasses import dataclass, field, replace

from pyspark import StorageLevel
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluiceway.functions.stamps import instant_text
from sluiceway.sinks.admission import REASONS, judged, stored_rows, table_schema, takes_all


def append_rows(rows: DataFrame, table: str) -> None:
    """Append ``rows`` to an existing table, by column name.

    A missing table or a column the table lacks raises; a column the rows lack is NULL. A
    timestamp for a STRING column becomes ISO-8601 text in UTC.
    """
    spark = rows.sparkSession
    target = table_schema(rows, table)
    text = {f.name.lower() for f in target if isinstance(f.dataType, T.StringType)}
    times = [f.name for f in rows.schema if isinstance(f.dataType, T.TimestampType)]
    rows = rows.withColumns({c: instant_text(F.col(c)) for c in times if c.lower() in text})
    spark.sql(
        "INSERT INTO IDENTIFIER(:table) BY NAME SELECT * FROM {rows}",
        args={"table": table},
        rows=rows,
    )


@dataclass(frozen=True)
class InsertReport:
    """What became of one insert: how many rows went in, and which were refused and why.

    ``reasons`` counts refusals by column and reason. ``refused`` has the refused rows as they
    were given, with an array ``_refusals`` of column and reason; it is kept on the executors
    until :meth:`release`.
    """

    rows: int
    has_errors: bool
    error: str | None = None
    reasons: dict[tuple[str, str], int] = field(default_factory=dict)
    refused: DataFrame | None = None
    kept: DataFrame | None = None

    def release(self) -> None:
        """Drop the rows that are kept; ``refused`` would then be computed again."""
        if self.kept is not None:
            self.kept.unpersist()


# Error conditions by which Spark refuses rows that do not fit the table.
_REJECTED_ROWS = (
    "INSERT_COLUMN_ARITY_MISMATCH",
    "INCOMPATIBLE_DATA_FOR_TABLE",
    "CAST_OVERFLOW_IN_TABLE_INSERT",
    "EXCEED_LIMIT_LENGTH",
    "NOT_NULL_ASSERT_VIOLATION",
    "CHECK_CONSTRAINT_VIOLATION",
)


def insert_rows(rows: DataFrame, table: str, skip_refused: bool = False) -> InsertReport:
    """Append ``rows`` as one batch and report rows that do not fit, without raising.

    Rows are judged by the table's schema, see :mod:`sluiceway.sinks.admission`. Either all rows
    go in or none; with ``skip_refused`` those that fit do. Rows are evaluated once: where some
    may be refused they are kept, spilling to disk, between judging and inserting. A missing
    table, an error in the expressions that make the rows, or a failure of the cluster is not a
    matter of the table and does raise.
    """
    schema = table_schema(rows, table)
    if takes_all(rows, schema):
        return _insert(rows, table)
    checked = judged(rows, schema).persist(StorageLevel.MEMORY_AND_DISK)
    refused = checked.where(F.size(REASONS) > 0)
    told = refused.select(F.explode(REASONS).alias("r")).groupBy("r.column", "r.reason").count()
    # One row for each column and reason.
    reasons = {(r["column"], r["reason"]): r["count"] for r in told.collect()}
    if not reasons:
        report = _insert(stored_rows(checked, schema), table)
        checked.unpersist()
        return report
    error = "; ".join(f"{c}: {reason} ({n} rows)" for (c, reason), n in sorted(reasons.items()))
    kept = InsertReport(0, True, error, reasons, refused, checked)
    if not skip_refused:
        return kept
    done = _insert(stored_rows(checked.where(F.size(REASONS) == 0), schema), table)
    return replace(kept, rows=done.rows, error="; ".join(filter(None, (error, done.error))))


def _insert(rows: DataFrame, table: str) -> InsertReport:
    counted = Observation()
    try:
        append_rows(rows.observe(counted, F.count(F.lit(1)).alias("rows")), table)
    except PySparkException as error:
        if not (error.getCondition() or "").startswith(_REJECTED_ROWS):
            raise
        return InsertReport(0, True, str(error))
    return InsertReport(counted.get["rows"], False)
