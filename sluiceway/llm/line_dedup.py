"""Drop lines that other documents have too, and put the rest together again.

Lines are exploded with their position, normalised (ASCII white space stripped at both
ends, A-Z lower-cased) and hashed to 128 bits. Only hashes, ids and positions are shuffled
for the counts: a first aggregation leaves one row per document and hash, a second counts
the documents of each hash, both with partial sums before the shuffle. Lines over the
threshold are then taken out of their documents by position.

Defined results: a NULL or empty text is one empty line. The document that keeps a line is
the one with the smallest id; a NULL id comes after all others and all rows with a NULL id
count as one document, as do rows that share an id. Every row is filtered by itself, so a
repeated row gets the same result twice. A line that occurs several times within the
document that keeps it stays each time. An empty table gives an empty result. Only the id
and the text column are interpreted; other columns may have any name.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluiceway.llm.frames import Scratch, col, fresh

# What is stripped from a line's ends, and the letters that lose their case.
_SPACE = " \t\n\x0b\x0c\r"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def line_key(line: Column) -> Column:
    return F.translate(F.btrim(line, F.lit(_SPACE)), _UPPER, _UPPER.lower())


def mark_lines(
    documents: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_length: int = 10,
    min_documents: int = 2,
) -> tuple[DataFrame, str, str]:
    """``documents`` with two more columns, whose names are returned too: all lines of the
    text, and the positions of those to drop (NULL if none).

    Dropped are lines whose key has ``min_length`` code points or more and is found in
    ``min_documents`` documents or more, except in the document with the smallest id.
    """
    lines_col, drops_col = fresh(documents, "_lines"), fresh(documents, "_drops")
    text = F.coalesce(col(text_col).cast("string"), F.lit(""))
    # A row is known by its id and its text, so that rows which share an id stay apart.
    rows = documents.select(
        col(id_col).alias("id"), F.xxhash64(text).alias("row"), text.alias("text")
    )
    lines = (
        rows.select("id", "row", F.posexplode(F.split("text", "\n", -1)).alias("pos", "line"))
        .withColumn("line", line_key(F.col("line")))
        .where(F.char_length("line") >= min_length)
        .select("id", "row", "pos", F.unhex(F.md5("line")).alias("hash"))
    )
    per_document = lines.groupBy("hash", "id").agg(F.lit(1).alias("one"))
    order = F.struct(F.isnull("id").alias("last"), F.col("id").alias("id"))
    repeated = (
        per_document.groupBy("hash")
        .agg(F.count(F.lit(1)).alias("documents"), F.min(order).alias("keeper"))
        .where(F.col("documents") >= min_documents)
    )
    # A line that very many documents have is one key of this join. The right side is read back
    # from a table, as Spark splits a skewed key only where both sides are plain shuffles.
    repeated = Scratch(documents.sparkSession).keep(repeated, "repeated")
    dropped = (
        lines.join(repeated, "hash")
        .where(~F.col("id").eqNullSafe(F.col("keeper.id")))
        .groupBy("id", "row")
        .agg(F.collect_set("pos").alias("drops"))
    )
    same_id, same_row = fresh(documents, "_same_id"), fresh(documents, "_same_row")
    dropped = dropped.withColumnsRenamed({"id": same_id, "row": same_row, "drops": drops_col})
    marked = documents.join(
        dropped,
        col(id_col).eqNullSafe(col(same_id)) & (F.xxhash64(text) == col(same_row)),
        "left",
    )
    marked = marked.select(
        *(col(c) for c in documents.columns), F.split(text, "\n", -1).alias(lines_col), drops_col
    )
    return marked, lines_col, drops_col


def kept_text(lines_col: str, drops_col: str) -> Column:
    """The lines that stay, in order."""

    def kept(lines: Column) -> Column:
        places = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), drops_col)
        return F.transform(places, lambda at: F.get(lines, at))

    # Through an array of one, so that the lines are made once and not for each place.
    some = F.element_at(F.transform(F.array(lines_col), kept), 1)
    return F.array_join(F.when(F.isnull(drops_col), F.col(lines_col)).otherwise(some), "\n")


def drop_repeated_lines(
    documents: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_length: int = 10,
    min_documents: int = 2,
) -> DataFrame:
    """``documents`` with the text that is left; a NULL text stays NULL."""
    marked, lines, drops = mark_lines(documents, id_col, text_col, min_length, min_documents)
    text = F.when(F.isnull(drops), col(text_col)).otherwise(kept_text(lines, drops))
    return marked.withColumn(text_col, text).select(*(col(c) for c in documents.columns))


def line_report(documents: DataFrame, **options) -> DataFrame:
    """``doc_id, n_lines, n_dropped, kept_sha256`` of every row."""
    marked, lines, drops = mark_lines(documents, **options)
    return marked.select(
        col(options.get("id_col", "doc_id")).alias("doc_id"),
        F.size(lines).cast("bigint").alias("n_lines"),
        F.coalesce(F.size(drops), F.lit(0)).cast("bigint").alias("n_dropped"),
        F.sha2(kept_text(lines, drops).cast("binary"), 256).alias("kept_sha256"),
    )


LINE_REPORT_SQL = r"""
WITH lines AS (
    SELECT doc_id, pos, line,
           trim(translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS key
    FROM (
        SELECT doc_id, unnest(parts) AS line, unnest(range(len(parts))) AS pos
        FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents)
    )
), repeated AS (
    SELECT key, min(doc_id) AS keeper
    FROM lines WHERE length(key) >= 10
    GROUP BY key HAVING count(DISTINCT doc_id) >= 2
)
SELECT doc_id,
       count(*) AS n_lines,
       count(repeated.key) FILTER (doc_id <> keeper) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos)
                       FILTER (keeper IS NULL OR doc_id = keeper), '')) AS kept_sha256
FROM lines LEFT JOIN repeated ON lines.key = repeated.key
GROUP BY doc_id
"""
