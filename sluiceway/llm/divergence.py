"""How much the sources of a language differ in their terms, in exact numbers.

Each source of a language gives each of the language's kept terms a probability from its count
there. Two sources differ by the sum of ``(p - q)^2 / (p + q)`` over all terms, and a term
sticks out in a source by the same measure against the whole language.

Terms are numbered by language and falling count, 64 to a word, so that terms of like counts are
neighbours. For each group (language and source), word and count there is one bitmap, a 64-bit
mask of the terms that occur so often in the group; a group's bitmaps at a word are disjoint. Two
groups are compared word by word: AND and popcount of two bitmaps is a joint cell, the number of
terms with count c here and d there, and is multiplied by the measure of c and d. Terms with
count 0 have no bitmap; their cells follow by complement, as a bitmap's terms that the other
group lacks are its size less its joint cells:

    sum = V f(0,0) + sum_c |c| (f(c,0) - f(0,0)) + sum_d |d| (f(0,d) - f(0,0))
          + sum_cd |c AND d| (f(c,d) - f(c,0) - f(0,d) + f(0,0))

Only counts by language, source and term are shuffled, after a first aggregation in the tasks
that read the texts, and dealt by language and term, so a hot source or a frequent term is a few
rows of each such task. Bitmaps are dealt by blocks of words and, where a language has more than
``GROUPS_AT_ONCE`` sources, by pairs of chunks of sources.

All arithmetic is on integers: 64 bits, decimals where products could be larger.

Defined results: NULL text, language and source count as empty texts, which form a language and
a source like any other. Each row counts as a document, repeated rows and rows with one id too.
A language without kept terms has pairs of value 0 and no terms. Ties are in the byte order of
the item. A very long text is counted whole. An empty table gives an empty result. Only the three named columns are read.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sluiceway.llm.frames import Scratch, col, text_bytes, text_groups
from sluiceway.llm.terms import letters, terms_of

#: Rows of counts that a task gathers before it adds them up, and passes on if still many.
BUFFERED_ROWS = 1_000_000
#: Words of 64 terms in a block, and sources that are compared with others at once.
BLOCK_WORDS, GROUPS_AT_ONCE = 64, 32
SCALE = 1_000_000_000


def term_counts(texts: DataFrame) -> DataFrame:
    """``lang, source, term, n, d``: occurrences, and rows that have the term, partly added up.

    ``texts`` has ``lang, source, text`` without NULLs.
    """
    member = letters()
    keys = ["lang", "source", "term"]

    def counted(batch: pa.RecordBatch) -> Iterator[pa.Table]:
        lang, source = (batch.column(k).dictionary_encode() for k in keys[:2])
        sources = max(len(source.dictionary), 1)
        pair = lang.indices.to_numpy().astype(np.int64) * sources + source.indices.to_numpy()
        pairs, group = np.unique(pair, return_inverse=True)
        for at, texts in text_groups(batch.column("text")):
            terms, first = terms_of(*text_bytes(texts), member)
            coded = terms.dictionary_encode()
            kinds = max(len(coded.dictionary), 1)
            row = np.repeat(np.arange(len(texts)), np.diff(first))
            # Each term of each text once, then each term of each group once.
            once, times = np.unique(row * kinds + coded.indices.to_numpy(), return_counts=True)
            own = group[at + once // kinds] * kinds + once % kinds
            cell, back = np.unique(own, return_inverse=True)
            n, d = np.zeros(len(cell), np.int64), np.bincount(back, minlength=len(cell))
            np.add.at(n, back, times)
            where = pairs[cell // kinds]
            yield pa.table(
                {
                    "lang": lang.dictionary.take(pa.array(where // sources)),
                    "source": source.dictionary.take(pa.array(where % sources)),
                    "term": coded.dictionary.take(pa.array(cell % kinds)).cast(pa.binary()).view(pa.string()),
                    "n": n,
                    "d": d.astype(np.int64),
                }
            )

    def added(tables: list[pa.Table]) -> pa.Table:
        total = pa.concat_tables(tables).group_by(keys).aggregate([("n", "sum"), ("d", "sum")])
        return total.rename_columns({"n_sum": "n", "d_sum": "d"}).select([*keys, "n", "d"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0
        for batch in batches:
            for table in counted(batch):
                held.append(table)
                rows += len(table)
                if rows >= BUFFERED_ROWS:
                    held = [added(held)]
                    rows = len(held[0])
                    if rows >= BUFFERED_ROWS // 2:
                        yield from held[0].to_batches(max_chunksize=100_000)
                        held, rows = [], 0
        if held:
            yield from added(held).to_batches(max_chunksize=100_000)

    return texts.mapInArrow(count, "lang string, source string, term string, n bigint, d bigint")


def probability(count: Column, total: Column, terms: Column) -> Column:
    """``1 + floor(SCALE * (count + 2) / (total + 2 * terms))``; 0 without terms."""
    product = (count + 2).cast("decimal(27,0)") * F.lit(SCALE).cast("decimal(10,0)")
    below = F.nullif(total + 2 * terms, F.lit(0)).cast("decimal(20,0)")
    share = F.call_function("div", product, below)
    return F.coalesce(1 + share, F.lit(0).cast("bigint"))


def difference(p: Column, q: Column) -> Column:
    """``floor((p - q)^2 / (p + q))``; 0 if both are."""
    return F.coalesce(F.call_function("div", (p - q) * (p - q), F.nullif(p + q, F.lit(0))), F.lit(0))


def kept_terms(texts: DataFrame, min_documents: int) -> DataFrame:
    """``lang, source, term, n, total, lead`` of the terms in enough rows of their language:
    occurrences there and in the language, and a mark on one row of each term."""
    # Dealt by language and term once, for both aggregations.
    counts = term_counts(texts).repartition("lang", "term").groupBy("lang", "term", "source")
    counts = counts.agg(F.sum("n").alias("n"), F.sum("d").alias("d"))
    term = W.partitionBy("lang", "term")
    counts = counts.select(
        "lang", "source", "term", "n",
        F.sum("n").over(term).alias("total"),
        F.sum("d").over(term).alias("documents"),
        (F.min("source").over(term) == F.col("source")).alias("lead"),
    )
    return counts.where(F.col("documents") >= min_documents).drop("documents")


def group_table(texts: DataFrame, kept: DataFrame) -> DataFrame:
    """``lang, source, place, groups, n_terms, lang_total, total, p0`` of every group: its number
    in its language, kept terms, and the probability of a term it lacks."""
    groups = texts.select("lang", "source").distinct()
    lead = F.col("lead").cast("bigint")
    langs = kept.groupBy(F.col("lang").alias("_lang")).agg(
        F.sum(lead).alias("n_terms"), F.sum("n").alias("lang_total")
    )
    totals = kept.groupBy(F.col("lang").alias("_l"), F.col("source").alias("_s")).agg(F.sum("n").alias("total"))
    groups = groups.join(langs, F.col("lang") == F.col("_lang"), "left")
    groups = groups.join(totals, (F.col("lang") == F.col("_l")) & (F.col("source") == F.col("_s")), "left")
    # One row for each group goes through these windows.
    lang = W.partitionBy("lang")
    groups = groups.select(
        "lang", "source",
        (F.row_number().over(lang.orderBy("source")) - 1).alias("place"),
        F.count(F.lit(1)).over(lang).cast("int").alias("groups"),
        *(F.coalesce(c, F.lit(0).cast("bigint")).alias(c) for c in ("n_terms", "lang_total", "total")),
    )
    zero = F.lit(0).cast("bigint")
    return groups.withColumn("p0", probability(zero, F.col("total"), F.col("n_terms")))


def count_bitmaps(counts: DataFrame) -> DataFrame:
    """``lang, block, word, place, groups, n, p, p0, mask``: for each group and count ``n``, of
    probability ``p``, the terms of a word that have it.

    ``counts`` has ``lang, term, total, place, groups, n, p, p0``.
    """
    order = ["lang", F.desc("total"), "term"]
    dealt = counts.repartitionByRange(*order).sortWithinPartitions(*order, "place")
    dealt = dealt.select("lang", "term", "place", "groups", "n", "p", "p0", F.spark_partition_id().alias("part"))
    keys = ["lang", "word", "place", "groups", "n", "p", "p0"]

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before, at = None, -1  # the last term, and its number
        for batch in batches:
            if not batch.num_rows:
                continue
            lang, term = batch.column("lang"), batch.column("term")
            new_lang = np.ones(len(lang), bool)
            new_term = np.ones(len(lang), bool)
            new_lang[1:] = _changes(lang)
            new_term[1:] = _changes(term) | new_lang[1:]
            if before is not None:
                new_lang[0] = lang[0].as_py() != before[0]
                new_term[0] = new_lang[0] or term[0].as_py() != before[1]
            number = at + np.cumsum(new_term)
            for row in np.flatnonzero(new_lang):
                # A language begins with a word of its own.
                number[row:] += -number[row] % 64
            before, at = (lang[-1].as_py(), term[-1].as_py()), int(number[-1])
            part = batch.column("part").to_numpy().astype(np.int64)
            bits = np.uint64(1) << (number % 64).astype(np.uint64)
            table = pa.table(
                {"word": part << 40 | number // 64, "bits": bits}
                | {k: batch.column(k) for k in keys if k != "word"}
            )
            # The bits of a word differ, so their sum is their union.
            packed = table.group_by(keys).aggregate([("bits", "sum")])
            masks = packed["bits_sum"].combine_chunks().view(pa.int64())
            table = packed.select(keys).append_column("mask", masks)
            yield from table.combine_chunks().to_batches()

    schema = "lang string, word bigint, place int, groups int, n bigint, p bigint, p0 bigint, mask bigint"
    packed = dealt.mapInArrow(pack, schema)
    return packed.withColumn("block", F.floor(F.col("word") / BLOCK_WORDS))


def _changes(values: pa.Array) -> np.ndarray:
    """Where a value differs from the one before, from the second on."""
    return pa.compute.not_equal(values[1:], values[:-1]).to_numpy(False)


def _measure(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // (p + q)


def joint_sums(bitmaps: DataFrame) -> DataFrame:
    """``lang, low, high, joint``: for two groups with common terms, by their places, the sum of
    the joint cells, parts of it in several rows."""
    chunk = F.floor(F.col("place") / GROUPS_AT_ONCE)
    chunks = F.floor((F.col("groups") - 1) / GROUPS_AT_ONCE)
    rows = bitmaps.withColumn("own", chunk).withColumn(
        "other", F.explode(F.sequence(F.lit(0).cast("bigint"), chunks))
    )
    rows = rows.select(
        "lang", "block", "word", "place", "p", "p0", "mask", "own",
        F.least("own", "other").alias("first"), F.greatest("own", "other").alias("second"),
    )

    def cells(table: pa.Table) -> pa.Table:
        table = table.sort_by([("word", "ascending"), ("place", "ascending")])
        word, place, p, p0, own = (table[c].to_numpy() for c in ("word", "place", "p", "p0", "own"))
        mask = table["mask"].to_numpy().view(np.uint64)
        lang, first, second = (table[c][0].as_py() for c in ("lang", "first", "second"))
        sums = np.zeros((2 * GROUPS_AT_ONCE, 2 * GROUPS_AT_ONCE), np.int64)
        base = (first * GROUPS_AT_ONCE, second * GROUPS_AT_ONCE)
        slot = np.where(own == first, place - base[0], GROUPS_AT_ONCE + place - base[1])
        starts = np.flatnonzero(np.diff(word, prepend=word[0] - 1))
        for a, b in zip(starts, np.append(starts[1:], len(word))):
            # Rows are in order of place: those of the first chunk come first.
            middle = b if first == second else a + int(np.searchsorted(own[a:b], second))
            left, right = slice(a, middle), slice(a if first == second else middle, b)
            common = mask[left, None] & mask[None, right]
            i, j = np.nonzero(common)
            n = np.bitwise_count(common[i, j]).astype(np.int64)
            i, j = i + left.start, j + right.start
            if first == second:
                once = i < j
                i, j, n = i[once], j[once], n[once]
            value = _measure(p[i], p[j]) - _measure(p[i], p0[j]) - _measure(p0[i], p[j])
            np.add.at(sums, (slot[i], slot[j]), n * (value + _measure(p0[i], p0[j])))
        i, j = np.nonzero(sums)
        low = np.where(i < GROUPS_AT_ONCE, base[0] + i, base[1] + i - GROUPS_AT_ONCE)
        high = np.where(j < GROUPS_AT_ONCE, base[0] + j, base[1] + j - GROUPS_AT_ONCE)
        return pa.table(
            {
                "lang": pa.array([lang] * len(i), pa.string()),
                "low": low.astype(np.int32),
                "high": high.astype(np.int32),
                "joint": sums[i, j],
            }
        )

    grouped = rows.groupBy("lang", "block", "first", "second")
    return grouped.applyInArrow(cells, "lang string, low int, high int, joint bigint")


def pair_values(bitmaps: DataFrame, groups: DataFrame) -> DataFrame:
    """``lang, source, item, value`` of every two sources of a language, both ways."""
    side = ("place", "source", "p0")
    one = groups.select("lang", "n_terms", *(F.col(c).alias(f"{c}_1") for c in side))
    two = groups.select("lang", *(F.col(c).alias(f"{c}_2") for c in side))
    # As many rows as the result has.
    pairs = one.join(two, "lang").where("place_1 <> place_2")
    none = difference(F.col("p0_1"), F.col("p0_2"))
    levels = bitmaps.groupBy("lang", "place", "p", "p0").agg(F.sum(F.bit_count("mask")).alias("size"))
    others = groups.select(F.col("lang"), F.col("place").alias("other"), F.col("p0").alias("q0"))
    lacking = difference(F.col("p"), F.col("q0")) - difference(F.col("p0"), F.col("q0"))
    sides = (
        levels.join(others, "lang")
        .where("place <> other")
        .groupBy("lang", "place", "other")
        .agg(F.sum(F.col("size") * lacking).alias("part"))
    )
    joint = joint_sums(bitmaps).groupBy("lang", "low", "high").agg(F.sum("joint").alias("part"))
    parts = _added(
        sides.select("lang", "place", "other", "part"),
        sides.select("lang", F.col("other").alias("place"), F.col("place").alias("other"), "part"),
        joint.select("lang", F.col("low").alias("place"), F.col("high").alias("other"), "part"),
        joint.select("lang", F.col("high").alias("place"), F.col("low").alias("other"), "part"),
    )
    same = (F.col("lang") == F.col("_lang")) & (F.col("place_1") == F.col("place")) & (F.col("place_2") == F.col("other"))
    pairs = pairs.join(parts.withColumnRenamed("lang", "_lang"), same, "left")
    value = F.col("n_terms") * none + F.coalesce("part", F.lit(0).cast("bigint"))
    return pairs.select("lang", F.col("source_1").alias("source"), F.col("source_2").alias("item"), value.alias("value"))


def _added(*parts: DataFrame) -> DataFrame:
    """The sum of ``part`` for each two places of a language."""
    total = parts[0]
    for part in parts[1:]:
        total = total.unionByName(part)
    return total.groupBy("lang", "place", "other").agg(F.sum("part").alias("part"))


def divergence_report(
    documents: DataFrame,
    min_documents: int = 10,
    top: int = 10,
    lang_col: str = "lang",
    source_col: str = "source",
    text_col: str = "text",
) -> DataFrame:
    """``lang, source, part, item, value, rank``: in part ``pair`` all other sources of the
    language, in part ``term`` the ``top`` terms that are more frequent than in the language."""
    scratch = Scratch(documents.sparkSession)
    texts = documents.select(
        *(
            F.coalesce(col(given).cast("string"), F.lit("")).alias(name)
            for given, name in ((lang_col, "lang"), (source_col, "source"), (text_col, "text"))
        )
    )
    kept = scratch.keep(kept_terms(texts, min_documents), "kept")
    groups = scratch.keep(group_table(texts, kept), "groups")
    counts = kept.join(groups.withColumnRenamed("total", "own_total"), ["lang", "source"])
    counts = counts.withColumn("p", probability(F.col("n"), F.col("own_total"), F.col("n_terms")))
    bitmaps = scratch.keep(count_bitmaps(counts), "bitmaps")
    by_value = W.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pairs = pair_values(bitmaps, groups).withColumn("rank", F.row_number().over(by_value))

    q = probability(F.col("total"), F.col("lang_total"), F.col("n_terms"))
    terms = counts.withColumn("q", q).where("p > q")
    terms = terms.select(
        "lang", "source", F.col("term").alias("item"), difference(F.col("p"), F.col("q")).alias("value")
    )
    # Spark keeps only the first ranks of each task before it shuffles.
    terms = terms.withColumn("rank", F.row_number().over(by_value)).where(F.col("rank") <= top)
    columns = lambda part: ["lang", "source", F.lit(part).alias("part"), "item", "value", "rank"]
    return pairs.select(*columns("pair")).unionByName(terms.select(*columns("term")))


DIVERGENCE_SQL = r"""
WITH texts AS (
    SELECT row_number() OVER () AS row, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
    FROM documents
), words AS (
    SELECT row, lang, source,
           unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM texts
), kept AS (
    SELECT lang, term, count(*) AS total
    FROM words GROUP BY lang, term HAVING count(DISTINCT row) >= 10
), sizes AS (
    SELECT lang, count(*) AS v, sum(total) AS lang_total FROM kept GROUP BY lang
), counts AS (
    SELECT lang, source, term, count(*) AS n
    FROM words JOIN kept USING (lang, term) GROUP BY lang, source, term
), groups AS (
    SELECT g.lang, g.source, coalesce(sum(n), 0) AS own
    FROM (SELECT DISTINCT lang, source FROM texts) g
    LEFT JOIN counts ON counts.lang = g.lang AND counts.source = g.source
    GROUP BY g.lang, g.source
), cells AS (
    SELECT g.lang, g.source, term, coalesce(n, 0) AS n,
           CAST(1 + 1000000000::HUGEINT * (coalesce(n, 0) + 2) // (own + 2 * v) AS BIGINT) AS p,
           CAST(1 + 1000000000::HUGEINT * (total + 2) // (lang_total + 2 * v) AS BIGINT) AS q
    FROM groups g JOIN kept USING (lang) JOIN sizes USING (lang)
    LEFT JOIN counts USING (lang, source, term)
), pairs AS (
    SELECT a.lang, a.source, b.source AS item,
           coalesce(sum((x.p - y.p) * (x.p - y.p) // (x.p + y.p)), 0) AS value
    FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN cells x ON x.lang = a.lang AND x.source = a.source
    LEFT JOIN cells y ON y.lang = b.lang AND y.source = b.source AND y.term = x.term
    GROUP BY a.lang, a.source, b.source
), both_parts AS (
    SELECT lang, source, 'pair' AS part, item, CAST(value AS BIGINT) AS value FROM pairs
    UNION ALL
    SELECT lang, source, 'term', term, CAST((p - q) * (p - q) // (p + q) AS BIGINT)
    FROM cells WHERE n > 0 AND p > q
), ranked AS (
    SELECT *, CAST(row_number() OVER (
        PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
    FROM both_parts
)
SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= 10
"""
