"""Which rows a table takes, told row by row: rules compiled from the table's schema.

A row is refused for each column that the table lacks, that can't be stored there, whose value
the column's type can't hold, or that is NULL where it must not be. All rules are expressions of
one projection, so rows are looked at once and nothing is tried against the table.
"""

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

REFUSALS = "array<struct<column:string,reason:string>>"
#: The column with the reasons of :func:`judged`.
REASONS = "_refusals"

# Fixed value: where a column's metadata has the length of its text.
_TEXT_KIND = "__CHAR_VARCHAR_TYPE_STRING"

REQUIRED = "NULL in a required column"


@dataclass(frozen=True)
class Rule:
    """What a value of a column is stored as, and the reason why it is refused, NULL if it is
    not. Without a reason no value is."""

    column: str
    stored: Column
    refused: Column | None = None


def table_schema(rows: DataFrame, table: str) -> T.StructType:
    """The schema of an existing table; a missing one raises."""
    spark = rows.sparkSession
    return spark.sql("SELECT * FROM IDENTIFIER(:table) LIMIT 0", args={"table": table}).schema


def _storable(given: T.DataType, wanted: T.DataType) -> bool:
    """Whether values of a type may be stored as another at all, as in ANSI store assignment."""
    times = (T.DateType, T.TimestampType, T.TimestampNTZType)
    if isinstance(given, T.NullType) or given == wanted:
        return True
    if isinstance(wanted, T.StringType):
        return isinstance(given, T.AtomicType)
    for kind in (T.NumericType, times):
        if isinstance(given, kind) and isinstance(wanted, kind):
            return True
    if isinstance(given, T.ArrayType) and isinstance(wanted, T.ArrayType):
        return _storable(given.elementType, wanted.elementType)
    if isinstance(given, T.MapType) and isinstance(wanted, T.MapType):
        return _storable(given.keyType, wanted.keyType) and _storable(given.valueType, wanted.valueType)
    if isinstance(given, T.StructType) and isinstance(wanted, T.StructType):
        names = [f.name.lower() for f in given] == [f.name.lower() for f in wanted]
        return names and all(_storable(g.dataType, w.dataType) for g, w in zip(given, wanted))
    return False


def _lost(value: Column, stored: Column, kind: T.DataType) -> Column:
    """Whether a cast has made some value NULL, within arrays, maps and structs too."""
    lost = value.isNotNull() & stored.isNull()
    if isinstance(kind, T.ArrayType):
        inner = F.zip_with(value, stored, lambda x, y: _lost(x, y, kind.elementType))
        return lost | F.exists(inner, lambda x: x)
    if isinstance(kind, T.MapType):
        keys = _lost(F.map_keys(value), F.map_keys(stored), T.ArrayType(kind.keyType))
        return lost | keys | _lost(F.map_values(value), F.map_values(stored), T.ArrayType(kind.valueType))
    if isinstance(kind, T.StructType):
        for part in kind:
            inner = F.coalesce(_lost(value[part.name], stored[part.name], part.dataType), F.lit(False))
            lost = lost | inner
    return lost


def _rule(rows: DataFrame, field: T.StructField) -> Rule:
    given = next((f for f in rows.schema if f.name.lower() == field.name.lower()), None)
    wanted = field.dataType
    nothing = F.lit(None).cast(wanted)
    if given is None:
        return Rule(field.name, nothing, None if field.nullable else F.lit(REQUIRED))
    value = F.col(f"`{given.name}`")
    no_way = F.when(value.isNotNull(), f"{given.dataType.simpleString()} can't be stored as {wanted.simpleString()}")
    if not _storable(given.dataType, wanted):
        return Rule(field.name, nothing, no_way)
    stored, reasons = value, []
    if given.dataType != wanted and not isinstance(wanted, T.StringType):
        stored = value.try_cast(wanted)
        try:
            rows.select(stored)
        except AnalysisException:
            return Rule(field.name, nothing, no_way)
        out = F.coalesce(_lost(value, stored, given.dataType), F.lit(False))
        reasons.append(F.when(out, f"out of the range of {wanted.simpleString()}"))
    kind = field.metadata.get(_TEXT_KIND, "")
    if kind.startswith(("varchar(", "char(")):
        # Blanks beyond the length are cut, as the table does.
        most = int(kind[kind.index("(") + 1 : -1])
        reasons.append(F.when(F.char_length(F.rtrim(value.cast("string"))) > most, f"longer than {kind}"))
    if not field.nullable:
        reasons.append(F.when(value.isNull(), REQUIRED))
    return Rule(field.name, stored, F.coalesce(*reasons) if reasons else None)


def _rules(rows: DataFrame, schema: T.StructType) -> list[Rule]:
    """A rule for each column of the table, in its order, and for each that it lacks."""
    known = {f.name.lower() for f in schema}
    unknown = [c for c in rows.columns if c.lower() not in known]
    return [_rule(rows, f) for f in schema] + [Rule(c, F.lit(None), F.lit("no such column")) for c in unknown]


def takes_all(rows: DataFrame, schema: T.StructType) -> bool:
    """Whether the types alone tell that no row is refused."""
    return all(rule.refused is None for rule in _rules(rows, schema))


def judged(rows: DataFrame, schema: T.StructType) -> DataFrame:
    """``rows`` with ``_refusals``: a struct of column and reason for each refusal, in the order
    of the table's columns and then of columns that it lacks. Rows that fit have none."""
    told = [
        F.when(rule.refused.isNotNull(), F.struct(F.lit(rule.column).alias("column"), rule.refused.alias("reason")))
        for rule in _rules(rows, schema)
        if rule.refused is not None
    ]
    refusals = F.array_compact(F.array(*told)) if told else F.array()
    return rows.withColumn(REASONS, refusals.cast(REFUSALS))


def stored_rows(rows: DataFrame, schema: T.StructType) -> DataFrame:
    """The columns of ``rows`` that the table has, as it stores them."""
    given = {c.lower() for c in rows.columns}
    rules = [_rule(rows, field) for field in schema if field.name.lower() in given]
    return rows.select(*(rule.stored.alias(rule.column) for rule in rules))
