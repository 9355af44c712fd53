"""Find benchmark passages in documents by Wu-Manber multi-pattern search over words.

A pattern is a window: so many consecutive words of a benchmark item, or the whole item if
it has fewer. The symbols of the search are words (their 64-bit hashes), not bytes: blocks
of ``BLOCK_WORDS`` words are rare enough that most positions of a text are skipped. For
each pattern length there is a table of shifts, from the last block of the text under the
pattern to how far the pattern may move; where it may not move, the hash of the pattern's
suffix selects the patterns that may end here, and their words are compared directly.
All texts of a batch move on side by side, one look at the table each.

Tables are numpy arrays, sorted by hash, over one buffer of benchmark text, made once on the
driver: about 8 bytes of memory for each byte of benchmark text, measured. Benchmarks are not
bounded, so patterns are taken in chunks of at most ``CHUNK_BYTES`` of text, each broadcast and
searched in a pass of its own whose result is kept before the next; one chunk is the rule.

Defined results: NULL, empty and wordless texts have no words, and as items no windows. An
item with a NULL id is ignored; ids are compared as strings, and items that share an id are
one item with the windows of all. Documents are independent of each other and each row gets
a result, so ties, repeated rows and NULL ids need no rule. Empty tables give an empty
result, or documents without hits. Very long texts are searched whole. Other columns may have any name.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluiceway.llm.frames import Scratch, col, fresh, text_bytes, text_groups
from sluiceway.llm.words import Words, letters_and_digits, lower_ascii, mix, words_of

BLOCK_WORDS = 3
#: Benchmark text whose patterns are broadcast at once.
CHUNK_BYTES = 16 << 20
#: Pairs of a place and a pattern that are compared at once.
PAIRS_AT_ONCE = 1 << 18


class Patterns:
    """The words of all items, and a :class:`Table` for each length that windows have."""

    def __init__(self, items: list[tuple[str, str]], window: int):
        self.ids = sorted({i for i, _ in items})
        number = {i: k for k, i in enumerate(self.ids)}
        texts = pa.array([text for _, text in items], pa.large_string())
        buffers, hashes, starts, stops, firsts = [], [], [], [], [np.zeros(1, np.int64)]
        size = count = 0
        for _, group in text_groups(texts):
            data, offsets = text_bytes(group)
            words = words_of(data, offsets, letters_and_digits())
            buffers.append(lower_ascii()[data])
            hashes.append(words.hashes)
            starts.append(words.start + size)
            stops.append(words.stop + size)
            firsts.append(words.first[1:] + count)
            size, count = size + len(data), count + len(words.hashes)

        def joined(parts: list[np.ndarray], kind: type) -> np.ndarray:
            return np.concatenate(parts).astype(kind) if parts else np.zeros(0, kind)

        self.low, self.hashes = joined(buffers, np.uint8), joined(hashes, np.uint64)
        self.start, self.stop = joined(starts, np.int32), joined(stops, np.int32)
        first = np.concatenate(firsts)
        own = np.array([number[i] for i, _ in items], np.int32)
        lengths = np.minimum(np.diff(first), window)
        self.tables = [
            Table(self, n, first[:-1][lengths == n], first[1:][lengths == n], own[lengths == n])
            for n in np.unique(lengths[lengths > 0]).tolist()
        ]

    def bytes(self) -> int:
        """Memory of the arrays."""
        arrays = [self.low, self.hashes, self.start, self.stop]
        arrays += [x for t in self.tables for x in (t.blocks, t.shifts, t.suffixes, t.begins, t.items)]
        return sum(x.nbytes for x in arrays)

    def find(self, low: np.ndarray, words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The first word, the length and the item of each window in the texts of ``words``."""
        found = [part for table in self.tables for part in table.find(self, low, words)]
        if not found:
            return (np.zeros(0, np.int64),) * 3
        return tuple(np.concatenate(columns) for columns in zip(*found))


class Table:
    """Shifts by block and windows by the hash of their last block, for windows of one length.

    Items are the words from ``first`` to ``last``, each with its number in ``item``.
    """

    def __init__(self, patterns: Patterns, length: int, first: np.ndarray, last: np.ndarray, item: np.ndarray):
        self.length, self.block = length, min(BLOCK_WORDS, length)
        hashes = _blocks(patterns.hashes, self.block)
        reach = length - self.block
        # A block after the first windows' worth of an item ends some window: shift 0. An earlier
        # one is in the item's first window, and as far from its end.
        counts = last - first - self.block + 1
        nth = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
        at = np.repeat(first, counts) + nth
        value, shift = hashes[at], np.maximum(reach - nth, 0).astype(np.uint8)
        order = np.lexsort((shift, value))
        value, shift = value[order], shift[order]
        fresh_ = np.ones(len(value), bool)
        fresh_[1:] = value[1:] != value[:-1]
        self.blocks, self.shifts = value[fresh_], shift[fresh_]
        counts = last - first - length + 1
        nth = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
        begin, item = np.repeat(first, counts) + nth, np.repeat(item, counts)
        # A window that an item has several times is one pattern.
        whole = _blocks(patterns.hashes, length)[begin]
        suffix = hashes[begin + reach]
        order = np.lexsort((item, whole, suffix))
        once = np.ones(len(order), bool)
        once[1:] = (np.diff(whole[order]) != 0) | (np.diff(item[order]) != 0) | (np.diff(suffix[order]) != 0)
        order = order[once]
        self.suffixes, self.begins = suffix[order], begin[order].astype(np.int32)
        self.items = item[order].astype(np.int32)

    def find(self, patterns: Patterns, low: np.ndarray, words: Words) -> Iterator[tuple[np.ndarray, ...]]:
        first, last = words.first[:-1], words.first[1:]
        long = np.flatnonzero(last - first >= self.length)
        if not len(long):
            return
        blocks = _blocks(words.hashes, self.block)
        reach = self.length - self.block
        # ``at`` is the block at the end of the window under test, in each text.
        at, stop = first[long] + reach, last[long] - self.block + 1
        ends = []
        while len(at):
            value = blocks[at]
            place = np.minimum(np.searchsorted(self.blocks, value), len(self.blocks) - 1)
            shift = np.where(self.blocks[place] == value, self.shifts[place], reach + 1).astype(np.int64)
            ends.append(at[shift == 0])
            at = at + np.maximum(shift, 1)
            going = at < stop
            at, stop = at[going], stop[going]
        end = np.concatenate(ends)
        low_, high = (np.searchsorted(self.suffixes, blocks[end], side) for side in ("left", "right"))
        load = np.cumsum(high - low_)
        cuts = np.searchsorted(load, np.arange(0, load[-1] + 1, PAIRS_AT_ONCE)) if len(load) else []
        for a, b in zip(cuts, [*cuts[1:], len(end)]):
            counts = (high - low_)[a:b]
            nth = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
            pattern = np.repeat(low_[a:b], counts) + nth
            begin = np.repeat(end[a:b] - reach, counts)
            for k in range(self.length):
                same = words.hashes[begin + k] == patterns.hashes[self.begins[pattern] + k]
                begin, pattern = begin[same], pattern[same]
            equal = [
                _phrase(low, words, x, x + self.length) == _phrase(patterns.low, patterns, y, y + self.length)
                for x, y in zip(begin.tolist(), self.begins[pattern].tolist())
            ]
            begin, pattern = begin[equal], pattern[equal]
            yield begin, np.full(len(begin), self.length), self.items[pattern].astype(np.int64)


def _phrase(low: np.ndarray, words: Words | Patterns, first: int, last: int) -> bytes:
    """Words as bytes, with a space between."""
    return b" ".join(
        low[a:b].tobytes() for a, b in zip(words.start[first:last], words.stop[first:last])
    )


def _blocks(hashes: np.ndarray, size: int) -> np.ndarray:
    """One hash for each run of ``size`` words."""
    count = max(len(hashes) - size + 1, 0)
    joined = hashes[:count].copy()
    for k in range(1, size):
        joined *= np.uint64(0x9FB21C651E98DF25)
        joined += hashes[k : count + k]
    return mix(joined)


_MATCHES = "n_words bigint, hits array<struct<a:bigint,b:bigint>>, items array<string>"
_RUN = pa.struct([("a", pa.int64()), ("b", pa.int64())])


def _search(items: list[tuple[str, str]], window: int, spark):
    """A function over Arrow batches with columns ``text`` and any others: these others and
    the matches. ``hits`` has the first and the last word of each run of hit words. Also the
    broadcast patterns, to be given up when the function is no longer needed."""
    shared = spark.sparkContext.broadcast(Patterns(items, window))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        patterns = shared.value
        for batch in batches:
            others = [name for name in batch.schema.names if name != "text"]
            for at, texts in text_groups(batch.column("text")):
                data, offsets = text_bytes(texts)
                words = words_of(data, offsets, letters_and_digits())
                begin, length, item = patterns.find(lower_ascii()[data], words)
                edges = np.zeros(len(words.hashes) + 1, np.int32)
                np.add.at(edges, begin, 1)
                np.subtract.at(edges, begin + length, 1)
                hit = np.cumsum(edges[:-1]) > 0
                text = np.searchsorted(words.first, begin, "right") - 1
                pairs = np.unique(text * max(len(patterns.ids), 1) + item)
                hits, found = [[] for _ in range(len(texts))], [[] for _ in range(len(texts))]
                for pair in pairs.tolist():
                    found[pair // len(patterns.ids)].append(patterns.ids[pair % len(patterns.ids)])
                for i in np.unique(text).tolist():
                    hits[i] = _runs(hit[words.first[i] : words.first[i + 1]])
                rows = batch.slice(at, len(texts))
                yield pa.RecordBatch.from_arrays(
                    [
                        *(rows.column(name) for name in others),
                        pa.array(np.diff(words.first), pa.int64()),
                        pa.array(hits, pa.list_(_RUN)),
                        pa.array(found, pa.list_(pa.string())),
                    ],
                    [*others, "n_words", "hits", "items"],
                )

    return search, shared


def _runs(hit: np.ndarray) -> list[dict]:
    """First and last position of each run of true values."""
    edges = np.flatnonzero(np.diff(np.concatenate(([False], hit, [False])).astype(np.int8)))
    return [{"a": a, "b": b - 1} for a, b in zip(edges[::2].tolist(), edges[1::2].tolist())]


def benchmark_matches(
    documents: DataFrame,
    benchmark: DataFrame,
    window: int = 13,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """``doc_id, n_words, n_hit, items`` of every row; ``items`` has the ids found, sorted.

    ``n_hit`` counts the words inside any occurrence of a window.
    """
    spark = documents.sparkSession
    rows = documents.select(col(id_col).alias("doc_id"), col(text_col).cast("string").alias("text"))
    items = benchmark.select(
        col(item_col).cast("string").alias("id"), col(item_text_col).cast("string").alias("text")
    ).where("id IS NOT NULL AND text IS NOT NULL")
    size = items.agg(F.sum(F.octet_length("text") + F.octet_length("id") + 16)).head()[0] or 0
    schema = T.StructType([rows.schema["doc_id"], *T.StructType.fromDDL(_MATCHES)])
    if size <= CHUNK_BYTES:
        search, _ = _search([tuple(r) for r in items.collect()], window, spark)
        found = rows.mapInArrow(search, schema)
    else:
        found = _in_chunks(rows, items, 1 + 2 * size // CHUNK_BYTES, window, schema)
    zero = F.lit(0).cast("bigint")
    n_hit = F.aggregate("hits", zero, lambda total, run: total + run["b"] - run["a"] + 1)
    return found.select("doc_id", "n_words", n_hit.alias("n_hit"), "items")


def _in_chunks(rows: DataFrame, items: DataFrame, chunks: int, window: int, schema: T.StructType) -> DataFrame:
    """As one search, for a benchmark in ``chunks`` parts; an item is in one part only."""
    spark = rows.sparkSession
    parts = items.withColumn("part", F.pmod(F.xxhash64("id", "text"), F.lit(chunks)))
    keyed = rows.withColumn("row", F.monotonically_increasing_id())
    # The row numbers must be the same in every pass.
    scratch = Scratch(spark)
    keyed = scratch.keep(keyed, "rows")
    schema = T.StructType([schema["doc_id"], keyed.schema["row"], *schema[1:]])
    passes = None
    for part in range(chunks):
        own = [tuple(r) for r in parts.where(F.col("part") == part).drop("part").collect()]
        search, shared = _search(own, window, spark)
        one = keyed.mapInArrow(search, schema)
        # The first pass gives every document its words, later ones what they have found.
        one = scratch.keep(one if part == 0 else one.where(F.size("items") > 0), f"pass-{part}")
        shared.unpersist()
        passes = one if passes is None else passes.union(one)
    gathered = passes.groupBy("row").agg(
        F.first("doc_id").alias("doc_id"),
        F.max("n_words").alias("n_words"),
        F.flatten(F.collect_list("hits")).alias("hits"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
    )
    return gathered.withColumn("hits", _merged_runs("hits"))


def _merged_runs(name: str) -> Column:
    """Runs from several passes, which may overlap, as runs that do not."""
    none = F.array().cast("array<struct<a:bigint,b:bigint>>")
    start = F.struct(F.lit(-1).cast("bigint").alias("end"), none.alias("runs"))

    def add(state: Column, run: Column) -> Column:
        rest = F.struct(F.greatest(run["a"], state["end"] + 1).alias("a"), run["b"].alias("b"))
        longer = F.struct(
            run["b"].alias("end"), F.concat(state["runs"], F.array(rest)).alias("runs")
        )
        return F.when(run["b"] <= state["end"], state).otherwise(longer)

    return F.aggregate(F.array_sort(name), start, add, lambda state: state["runs"])


def contaminated(n_hit: str = "n_hit", n_words: str = "n_words") -> Column:
    """At least one word in twenty is inside a benchmark window."""
    return (F.col(n_hit) > 0) & (20 * F.col(n_hit) >= F.col(n_words))


def contamination_report(documents: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """``doc_id, n_words, n_hit, n_items, items_sha256, contaminated`` of every row."""
    return benchmark_matches(documents, benchmark, **options).select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        contaminated().alias("contaminated"),
    )


def drop_contaminated(
    documents: DataFrame, benchmark: DataFrame, text_col: str = "text", **options
) -> DataFrame:
    """``documents`` without the contaminated ones. All columns go through the search, so
    rows are judged by themselves, whatever their ids."""
    row = fresh(documents, "_row")
    packed = documents.select(
        F.struct(*(col(c) for c in documents.columns)).alias(row), col(text_col).alias(row + "_text")
    )
    found = benchmark_matches(packed, benchmark, id_col=row, text_col=row + "_text", **options)
    clean = found.where(~contaminated())
    return clean.select(*(F.col("doc_id").getField(c).alias(c) for c in documents.columns))
