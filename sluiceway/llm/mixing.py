"""Mix sources to target weights by weighted fair queueing.

The documents of a source queue up in shuffled order, over as many rounds as the source may
repeat. A document's virtual finish time is the words that its source has queued up to its end,
divided by the source's target. All queues are put in one order of finish times, sorted by
ranges over the whole cluster, and served until the total budget is used up: a running sum in
two levels, of whole ranges and within each, tells where that is.

Service is fluid: the document that a source is being served when its target is reached is queued
in two pieces, up to there and from there on. As the targets add up to the budget, the pieces
that end by virtual time 1 use it up, so each source misses its target by less than a word. No
document is cut in text; ``taken`` tells how many of its words count.

1. Words are counted once. Small rows of id, hash of the text, source and size are kept; texts
   go through no sort and no window.
2. Queues are running sums of sizes in two levels, too, so a source with a third of all rows is
   no single task. Nothing but one row per source goes through a single window.
3. The schedule holds the pieces that begin by virtual time 1, some rounds of small rows.
4. Where other columns are wanted, documents meet what is taken of them by id and hash.

Defined results: the shuffled order is that of ``md5(id)``, with ties by id, size and hash, so
reruns agree; a NULL id is hashed as the empty text. A NULL text has size 0. A NULL source
is a source of its own, last in order. Documents of size 0 are taken 0 times their size.
Repeated rows are documents of their own. If all sizes are 0 all targets are 0. A very long text
is one small row. An empty table gives an empty result. Only id, text and source are read; other
columns may have any name.
"""

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sluiceway.llm.frames import Scratch, col
from sluiceway.llm.prefix_sums import running_sum

#: Rows of a source's shuffled order that are summed at once, about.
ROWS_AT_ONCE = 50_000


def word_count(text: Column) -> Column:
    """Longest runs of anything but space and ``\\t`` to ``\\r``."""
    # Each run becomes one letter, all else goes.
    runs = F.regexp_replace(text, r"[^\x20\x09-\x0D]+", "w")
    only = F.translate(runs, " \t\n\x0b\x0c\r", "")
    return F.coalesce(F.char_length(only).cast("bigint"), F.lit(0).cast("bigint"))


def source_targets(sizes: DataFrame, weights: tuple[int, ...], repeats: int) -> DataFrame:
    """``source, source_size, target``: the budget, all sizes, by weight; no source gets more
    than ``repeats`` times its size, and what it can't take is shared again by weight.

    ``sizes`` has ``source, size``. Sources in the order of their limit per weight are at
    their limit up to the first that is not; the rest share what is left.
    """
    sources = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    everything = W.partitionBy()
    # One row per source goes through these windows.
    place = F.row_number().over(everything.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*map(F.lit, weights)), place % len(weights) + 1)
    sources = sources.withColumn("weight", weight.cast("bigint"))
    sources = sources.withColumn("limit", F.col("source_size") * repeats)
    ratio = F.col("limit").cast("double") / F.col("weight")
    sources = sources.withColumn("ratio", ratio)
    by_ratio = everything.orderBy("ratio", F.col("source").asc_nulls_last())
    sources = sources.withColumn("nth", F.row_number().over(by_ratio))
    before = by_ratio.rowsBetween(W.unboundedPreceding, -1)
    left = F.sum("source_size").over(everything) - F.coalesce(F.sum("limit").over(before), F.lit(0))
    share = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    # Words per unit of weight if just the sources before this one are at their limit.
    sources = sources.withColumn("level", left.cast("double") / share)
    first = F.min(F.when(F.col("level") <= F.col("ratio"), F.struct("nth", "level")))
    level = first.over(everything)["level"]
    target = F.least(F.col("limit").cast("double"), level * F.col("weight"))
    return sources.select("source", "source_size", target.alias("target"))


def _sizes(documents: DataFrame, scratch: Scratch, id_col: str, text_col: str, source_col: str) -> DataFrame:
    """A small row of each document: ``n`` (unique), ``id, row, source, size, shuffled``."""
    text = col(text_col).cast("string")
    rows = documents.select(
        col(id_col).alias("id"),
        F.xxhash64(F.coalesce(text, F.lit(""))).alias("row"),
        col(source_col).cast("string").alias("source"),
        word_count(text).alias("size"),
        F.md5(F.coalesce(col(id_col).cast("string"), F.lit(""))).alias("shuffled"),
    )
    return scratch.keep(rows.withColumn("n", F.monotonically_increasing_id()), "sizes")


def _schedule(sizes: DataFrame, targets: DataFrame, repeats: int, scratch: Scratch) -> DataFrame:
    """The pieces that begin by virtual time 1, by ``range`` of finish times: ``n, id, source,
    size, round, finish, words`` and the place in the order."""
    # Ranges of the shuffled order, as many as keep each one small.
    digits = max(1, math.ceil(math.log(max(sizes.count(), 1) / ROWS_AT_ONCE, 16)))
    order = [F.col(c) for c in ("shuffled", "id", "size", "row")]
    bucket = F.substring("shuffled", 1, digits)
    queued = running_sum(sizes, "source", bucket, order, "size", "queued")
    queued = queued.join(
        targets.withColumnRenamed("source", "_told"), F.col("source").eqNullSafe(F.col("_told"))
    )
    rounds = F.explode(F.sequence(F.lit(0), F.lit(repeats - 1))).alias("round")
    queued = queued.where("size > 0").select("*", rounds)
    ahead = F.col("round") * F.col("source_size") + F.col("queued")
    whole = F.floor("target").cast("bigint")
    queued = queued.withColumn("ahead", ahead).where(F.col("ahead") <= whole)
    served = F.least(F.col("size"), whole - F.col("ahead"))

    def piece(words: Column, end: Column) -> Column:
        return F.struct(words.alias("words"), (end / F.col("target")).alias("finish"))

    pieces = F.array(
        piece(served, F.col("ahead") + served),
        piece(F.col("size") - served, F.col("ahead") + F.col("size")),
    )
    pieces = queued.select("n", "id", "row", "source", "size", "shuffled", "round", F.inline(pieces)).where("words > 0")
    dealt = pieces.repartitionByRange("finish", *_ORDER).withColumn("range", F.spark_partition_id())
    return scratch.keep(dealt, "schedule")


# What decides among pieces that finish at the same time.
_ORDER = ("source", "shuffled", "id", "size", "row", "round")


def _served(schedule: DataFrame, targets: DataFrame) -> DataFrame:
    """The schedule with ``taken``: the words of each piece before the budget is used up."""
    budget = targets.agg(F.sum(F.floor("target")).cast("bigint")).head()[0] or 0
    everything = schedule.withColumn("_all", F.lit(0))
    order = [F.col(c) for c in ("finish", *_ORDER)]
    summed = running_sum(everything, "_all", F.col("range"), order, "words", "before")
    left = F.greatest(F.lit(0).cast("bigint"), F.lit(budget) - F.col("before"))
    return summed.withColumn("taken", F.least("words", left)).drop("_all", "before")


def _mixed(
    documents: DataFrame, weights: tuple[int, ...], repeats: int, id_col: str, text_col: str, source_col: str
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Sizes, targets, and the served schedule."""
    scratch = Scratch(documents.sparkSession)
    sizes = _sizes(documents, scratch, id_col, text_col, source_col)
    targets = scratch.keep(source_targets(sizes.select("source", "size"), weights, repeats), "targets")
    return sizes, targets, _served(_schedule(sizes, targets, repeats, scratch), targets)


def mixing_schedule(
    documents: DataFrame,
    weights: tuple[int, ...] = (1, 2, 3),
    repeats: int = 3,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
) -> DataFrame:
    """What the mix takes in the order of service: ``id, source, size, round, finish, taken``."""
    _, _, served = _mixed(documents, weights, repeats, id_col, text_col, source_col)
    served = served.where("taken > 0").orderBy("finish", *_ORDER)
    return served.select("id", "source", "size", "round", "finish", "taken")


def mix_sources(
    documents: DataFrame,
    weights: tuple[int, ...] = (1, 2, 3),
    repeats: int = 3,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """``doc_id, size, source_size, target, taken`` of every document, and the columns to
    ``keep`` in a struct ``kept``: what :func:`mixing_schedule` takes of it in all rounds."""
    sizes, targets, served = _mixed(documents, weights, repeats, id_col, text_col, source_col)
    taken = served.groupBy(F.col("n").alias("_n")).agg(F.sum("taken").alias("taken"))
    rows = sizes.join(taken, F.col("n") == F.col("_n"), "left")
    rows = rows.join(targets.withColumnRenamed("source", "_told"), F.col("source").eqNullSafe(F.col("_told")))
    rows = rows.withColumn("taken", F.coalesce("taken", F.lit(0).cast("bigint")))
    report = ["size", "source_size", "target", "taken"]
    nothing = F.lit(0).alias("0")
    if not keep:
        return rows.select(F.col("id").alias("doc_id"), *report, F.struct(nothing).alias("kept"))
    # Rows with the same id, text and source share what is taken of them, in any order.
    key = ["_id", "_row", "_source"]
    shares = rows.select(
        F.col("id").alias("_i"), F.col("row").alias("_r"), F.col("source").alias("_s"),
        F.struct("taken", "size", "source_size", "target").alias("share"),
    )
    shares = shares.groupBy("_i", "_r", "_s").agg(F.sort_array(F.collect_list("share")).alias("shares"))
    text = F.coalesce(col(text_col).cast("string"), F.lit(""))
    kept = documents.select(
        col(id_col).alias("_id"),
        F.xxhash64(text).alias("_row"),
        col(source_col).cast("string").alias("_source"),
        F.struct(nothing, *(col(c) for c in keep)).alias("kept"),
    )
    same = [F.col(a).eqNullSafe(F.col(b)) for a, b in zip(key, ("_i", "_r", "_s"))]
    both = kept.join(shares, same[0] & same[1] & same[2])
    nth = F.row_number().over(W.partitionBy(*key).orderBy("_row"))
    both = both.withColumn("share", F.element_at("shares", nth))
    return both.select(F.col("_id").alias("doc_id"), *(f"share.{c}" for c in report), "kept")


MIX_SQL = r"""
WITH rows AS (
    SELECT doc_id, source, md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS shuffled,
           coalesce(len(regexp_extract_all(text, '[^ 	-
]+')), 0) AS size
    FROM documents
), sources AS (
    SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
           1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS weight
    FROM rows GROUP BY source
), limits AS (
    SELECT *, 3 * source_size AS most, CAST(3 * source_size AS DOUBLE) / weight AS ratio
    FROM sources
), levels AS (
    SELECT *, row_number() OVER (ORDER BY ratio, source NULLS LAST) AS nth,
           CAST(sum(source_size) OVER () - coalesce(sum(most) OVER before, 0) AS DOUBLE)
           / (sum(weight) OVER () - coalesce(sum(weight) OVER before, 0)) AS level
    FROM limits
    WINDOW before AS (ORDER BY ratio, source NULLS LAST
                      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), targets AS (
    SELECT source, source_size,
           least(CAST(most AS DOUBLE),
                 arg_min(level, nth) FILTER (level <= ratio) OVER () * weight) AS target
    FROM levels
), queued AS (
    SELECT doc_id, size, source_size, target,
           CAST(coalesce(sum(size) OVER (
               PARTITION BY rows.source ORDER BY shuffled, doc_id, size
               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS queued
    FROM rows JOIN targets ON rows.source IS NOT DISTINCT FROM targets.source
)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target,
       CAST(greatest(0, least(size, floor(target) - queued))
            + greatest(0, least(size, floor(target) - source_size - queued))
            + greatest(0, least(size, floor(target) - 2 * source_size - queued)) AS BIGINT) AS taken
FROM queued
"""
