"""Near-duplicate texts by an LSH forest over MinHash signatures.

Every text has ``TREES`` signatures of ``DEPTH`` MinHash values. A tree is the texts in the
sort order of one signature; texts next to each other there share a longest prefix, and the
texts that share a prefix are a region. Neighbours in the sort order are candidates, and
how deep a region has to agree adapts to it: a sparse region is compared as a whole at
``SHALLOW`` equal values, a crowded one is split by further values until it is sparse.

Candidates are confirmed on the full shingle sets. The first round confirms only a few
neighbours of each text, which connects groups of near copies without listing their pairs.
The second round takes all candidates whose texts are not connected yet. Where regions stay
crowded at full depth and hold several components, all their texts are compared across
components, block by block. So no candidate is dropped, and pairs inside a component are
never enumerated.

At a similarity of 0.8 a pair of texts shares ``SHALLOW`` values in none of the trees with a
probability of 5e-8, and, in crowded regions, ``DEPTH`` values in none with 0.3 %.

Defined results: NULL, empty and wordless texts have an empty set and link with nothing.
Texts with equal sets always link. Rows with the same id count as one node, each row gets
a result. A row with a NULL id has the component NULL and is kept. An empty table gives an
empty result. Only the id and the text column are read, so other columns may have any name.
"""

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluiceway.llm.components import connected_components
from sluiceway.llm.frames import Scratch, col, fresh, text_bytes, text_groups
from sluiceway.llm.words import mix, shingles_of, space_separated, words_of

TREES, DEPTH, SHALLOW = 32, 8, 4
#: A region of at most so many texts is sparse: all its pairs are candidates.
SPARSE = 16
#: Neighbours on each side that are candidates in the sort order of a region that is split.
WINDOW = 4
#: Shingles of the texts that are compared as one block.
BLOCK_SHINGLES = 1 << 17
#: Shingles that a text counts for at least, which bounds the texts of a block too.
TEXT_SHINGLES = 64
#: Trees whose direct neighbours are confirmed first.
FIRST_TREES = 4

_SKETCH = "id bigint, n bigint, d1 bigint, d2 bigint, trees array<struct<k:bigint,t1:bigint,t2:bigint>>"


def minhash_components(
    documents: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = 5,
    percent: int = 80,
) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` of every row of ``documents``.

    Two texts link if ``100 * |A n B| >= percent * |A u B|`` over their distinct shingles of
    ``shingle`` words (A-Z lower-cased, words apart by ASCII white space). ``component_id``
    is the smallest id reachable over links, ``kept`` marks the row that bears it.
    """
    scratch = Scratch(documents.sparkSession)
    texts = documents.select(
        col(id_col).cast("bigint").alias("id"), col(text_col).cast("string").alias("text")
    )
    sketches = scratch.keep(texts.mapInArrow(_sketcher(shingle), _SKETCH), "sketches")

    # One text stands for all with the same set.
    sets = sketches.where("n > 0 AND id IS NOT NULL").select("id", "n", "d1", "d2")
    classes = sets.groupBy("n", "d1", "d2").agg(F.min("id").alias("rep"))
    reps = classes.select(F.col("rep").alias("id")).distinct()
    found = scratch.keep(_candidates(sketches.where("n > 0"), reps, percent), "candidates")

    same = sets.join(classes, ["n", "d1", "d2"]).where("id <> rep")
    edges = same.select(F.col("id").alias("a"), F.col("rep").alias("b"))
    pairs = found.where("b IS NOT NULL")
    early = pairs.where("early").select("a", "b").distinct()
    links = scratch.keep(_confirmed(early, texts, shingle, percent), "early")
    labels = scratch.keep(connected_components(edges.union(links), scratch, "first"), "labels")

    late = _unconnected(pairs.where("NOT early").select("a", "b").distinct(), labels)
    crowded = found.where("b IS NULL")
    more = _confirmed(late, texts, shingle, percent).union(
        _across_components(crowded, texts, labels, shingle, percent, scratch)
    )
    more = scratch.keep(more, "late")
    # Components stand for their texts: the new links join components.
    merged = _labelled(more, labels).select(F.col("ca").alias("a"), F.col("cb").alias("b"))
    roots = connected_components(merged, scratch, "second")

    final = labels.join(
        roots.select(F.col("id").alias("component"), F.col("component").alias("root")),
        "component",
        "full",
    ).select(
        F.coalesce("id", "component").alias("id"), F.coalesce("root", "component").alias("component")
    )
    component = F.coalesce("component", "id")
    return (
        sketches.select("id", "n")
        .join(final.distinct(), "id", "left")
        .select(
            F.col("id").alias("doc_id"),
            F.col("n").alias("n_shingles"),
            component.alias("component_id"),
            F.col("id").eqNullSafe(component).alias("kept"),
        )
    )


def drop_near_duplicates(
    documents: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = 5,
    percent: int = 80,
) -> DataFrame:
    """``documents`` with one text of each component, the one with the smallest id."""
    found = minhash_components(documents, id_col, text_col, shingle, percent)
    gone = fresh(documents, "_gone")
    dropped = found.where("NOT kept").select(F.col("doc_id").alias(gone)).distinct()
    return documents.join(dropped, col(id_col).cast("bigint") == F.col(gone), "left_anti")


def _sketcher(shingle: int):
    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        functions = np.random.default_rng(20).integers(0, 1 << 32, (TREES * DEPTH, 2), np.uint32)
        functions[:, 0] |= np.uint32(1)
        for batch in batches:
            for at, texts in text_groups(batch.column("text")):
                ids = batch.column("id")[at : at + len(texts)]
                sets, first = shingles_of(words_of(*text_bytes(texts), space_separated()), shingle)
                yield _sketch_batch(ids, sets, first, _signatures(sets, first, functions))

    return sketch


def _signatures(sets: np.ndarray, first: np.ndarray, functions: np.ndarray) -> np.ndarray:
    """The minimum of each hash function over each set; sets without members have zeros."""
    signatures = np.zeros((len(first) - 1, len(functions)), np.uint32)
    small = (mix(sets.copy()) >> np.uint64(32)).astype(np.uint32)
    filled = np.flatnonzero(np.diff(first))
    at = 0
    while at < len(filled):  # so many sets that their members stay in the CPU's cache
        stop = int(np.searchsorted(first[filled], first[filled[at]] + (1 << 16), "right"))
        stop = max(stop, at + 1)
        rows = filled[at:stop]
        low, high = int(first[rows[0]]), int(first[rows[-1] + 1])
        members, starts = small[low:high], first[rows] - low
        hashed = np.empty_like(members)
        least = np.empty((len(functions), len(rows)), np.uint32)
        for j, (factor, shift) in enumerate(functions):
            np.multiply(members, factor, out=hashed)
            hashed ^= shift
            np.minimum.reduceat(hashed, starts, out=least[j])
        signatures[rows] = least.T
        at = stop
    return signatures


def _sketch_batch(
    ids: pa.Array, sets: np.ndarray, first: np.ndarray, signatures: np.ndarray
) -> pa.RecordBatch:
    n = np.diff(first)
    sums = [np.concatenate(([0], np.cumsum(x, dtype=np.uint64))) for x in (sets, mix(sets.copy()))]
    digests = [(s[first[1:]] - s[first[:-1]]).view(np.int64) for s in sums]
    values = signatures.reshape(len(n), TREES, DEPTH).astype(np.uint64)
    key = np.arange(1, TREES + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    key = np.broadcast_to(key, values.shape[:2])
    for d in range(SHALLOW):
        key = mix(key + values[:, :, d])
    tails = [
        (values[:, :, d] << np.uint64(32)) | values[:, :, d + 1] for d in range(SHALLOW, DEPTH, 2)
    ]
    columns = [pa.array(np.ascontiguousarray(x).reshape(-1).view(np.int64)) for x in (key, *tails)]
    trees = pa.ListArray.from_arrays(
        pa.array(np.arange(len(n) + 1, dtype=np.int32) * TREES),
        pa.StructArray.from_arrays(columns, ["k", "t1", "t2"]),
    )
    return pa.RecordBatch.from_arrays(
        [ids, pa.array(n), *map(pa.array, digests), trees], ["id", "n", "d1", "d2", "trees"]
    )


def _candidates(sketches: DataFrame, reps: DataFrame, percent: int) -> DataFrame:
    """``a, b, early`` of neighbours in the trees; ``a, NULL`` with ``region`` and its size
    ``n`` of members of regions that stay crowded at full depth."""
    rows = sketches.join(reps, "id", "left_semi").select("id", "n", F.posexplode("trees"))
    rows = rows.select("id", "n", (F.col("pos") < FIRST_TREES).alias("first_tree"), "col.*")
    # Hashed by a region's first values, so a region is in one partition; rows are small
    # numbers and stream through in sort order, however large a region is.
    ordered = rows.repartition("k").sortWithinPartitions("k", "t1", "t2", "id")
    schema = "a bigint, b bigint, early boolean, region bigint, n bigint"
    return ordered.mapInArrow(_neighbours(percent), schema)


def _neighbours(percent: int):
    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            rows = {name: batch.column(name).to_numpy(False) for name in batch.schema.names}
            if held is not None:
                rows = {name: np.concatenate((held[name], rows[name])) for name in rows}
            k = rows["k"]
            if not len(k):
                continue
            # The last region may go on in the next batch. One that is very long is crowded
            # all the same; its tail of a window's length is enough to go on.
            cut = int(np.flatnonzero(k == k[-1])[0]) if k[0] != k[-1] else 0
            if len(k) - cut > 100_000:
                yield from _region_pairs(rows, len(k), percent)
                held = {name: x[len(k) - SPARSE :] for name, x in rows.items()}
            else:
                if cut:
                    yield from _region_pairs(rows, cut, percent)
                held = {name: x[cut:] for name, x in rows.items()}
        if held is not None and len(held["k"]):
            yield from _region_pairs(held, len(held["k"]), percent)

    return over


def _region_pairs(rows: dict, count: int, percent: int) -> Iterator[pa.RecordBatch]:
    rows = {name: x[:count] for name, x in rows.items()}
    k, t1, t2, ids, n, first_tree = (rows[c] for c in ("k", "t1", "t2", "id", "n", "first_tree"))
    new = np.ones((3, count), bool)
    new[0, 1:] = k[1:] != k[:-1]
    new[1, 1:] = new[0, 1:] | (t1[1:] != t1[:-1])
    new[2, 1:] = new[1, 1:] | (t2[1:] != t2[:-1])
    at = np.arange(count)
    starts = [np.maximum.accumulate(np.where(flags, at, 0)) for flags in new]
    ends = []
    for flags in new:
        bounds = np.append(np.flatnonzero(flags), count)
        ends.append(bounds[np.cumsum(flags)])
    sizes = [end - start for start, end in zip(starts, ends)]
    # The shallowest region of each row that is sparse; crowded to the end: the row alone,
    # apart from the window.
    end = np.where(
        sizes[0] <= SPARSE, ends[0], np.where(sizes[1] <= SPARSE, ends[1], ends[2])
    )
    crowded = sizes[2] > SPARSE
    end = np.where(crowded, at + 1, end)
    # All texts of crowded regions meet later, so the next one and the first are enough there.
    reach = np.minimum(np.maximum(end, at + 1 + np.where(crowded, 1, WINDOW)), ends[0])
    left, right = [], []
    for step in range(1, SPARSE):
        some = np.flatnonzero(at + step < reach)
        if not len(some):
            break
        left.append(some)
        right.append(some + step)
    # Members of a crowded region also meet its first text.
    some = np.flatnonzero(crowded & (at - starts[2] > 1))
    left.append(starts[2][some])
    right.append(some)
    i, j = np.concatenate(left), np.concatenate(right)
    fits = 100 * np.minimum(n[i], n[j]) >= percent * np.maximum(n[i], n[j])
    fits &= ids[i] != ids[j]
    i, j = i[fits], j[fits]
    early = (first_tree[i] & (j - i == 1)) | (crowded[i] & (i == starts[2][j]))
    members = np.flatnonzero(crowded)
    none = np.zeros(len(members), bool)
    region = mix(k.view(np.uint64) + mix(t1.view(np.uint64) + mix(t2.view(np.uint64))))
    total = len(i) + len(members)
    for low in range(0, total, 100_000):
        part = slice(low, low + 100_000)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.concatenate((np.minimum(ids[i], ids[j]), ids[members]))[part]),
                pa.array(
                    np.concatenate((np.maximum(ids[i], ids[j]), ids[members]))[part],
                    mask=np.concatenate((np.zeros(len(i), bool), ~none))[part],
                ),
                pa.array(np.concatenate((early, none))[part]),
                pa.array(np.concatenate((k[i], region.view(np.int64)[members]))[part]),
                pa.array(np.concatenate((n[i], n[members]))[part]),
            ],
            ["a", "b", "early", "region", "n"],
        )


def _labelled(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """Pairs with the components of both, a text without links being its own."""
    a = labels.select(F.col("id").alias("a"), F.col("component").alias("_ca"))
    b = labels.select(F.col("id").alias("b"), F.col("component").alias("_cb"))
    return pairs.join(a, "a", "left").join(b, "b", "left").select(
        "a", "b", F.coalesce("_ca", "a").alias("ca"), F.coalesce("_cb", "b").alias("cb")
    )


def _unconnected(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    return _labelled(pairs, labels).where("ca <> cb").select("a", "b")


def _across_components(
    members: DataFrame,
    texts: DataFrame,
    labels: DataFrame,
    shingle: int,
    percent: int,
    scratch: Scratch,
) -> DataFrame:
    """Links ``a, b`` between components that meet in regions crowded at full depth.

    Components that meet, directly or over others, are a group. Its texts are dealt into
    blocks of ``BLOCK_SHINGLES``, short texts counting for ``TEXT_SHINGLES`` each, large
    components apart from the others, and all sets of two blocks are intersected at once, as a
    product of matrices. Two blocks of one component are left out, and no
    pair of texts is ever a row, so a large group of near copies costs blocks, not pairs.
    """
    own = members.select(F.col("a").alias("id"), "region", "n").distinct()
    own = own.join(labels, "id", "left")
    own = own.select("id", "region", "n", F.coalesce("component", "id").alias("c"))
    # Most such regions are one component by now.
    mixed = own.groupBy("region").agg(F.min("c").alias("low"), F.max("c").alias("high"))
    own = scratch.keep(own.join(mixed.where("low < high"), "region"), "crowded")
    meet = own.select(F.col("c").alias("a"), F.col("low").alias("b")).distinct()
    groups = connected_components(meet, scratch, "groups")
    groups = groups.select(F.col("id").alias("c"), F.col("component").alias("g"))
    docs = own.select("id", "n", "c").distinct().join(groups, "c")

    sizes = docs.groupBy("g", "c").agg(F.sum(F.greatest("n", F.lit(TEXT_SHINGLES))).alias("total"))
    large = F.col("total") >= BLOCK_SHINGLES // 2
    sizes = sizes.withColumn("part", F.when(large, F.col("c")).otherwise(F.lit(-1).cast("bigint")))
    parts = sizes.groupBy("g", "part").agg(F.sum("total").alias("part_total"))
    docs = docs.join(sizes, ["g", "c"]).join(parts, ["g", "part"])
    count = F.ceil(F.col("part_total") / BLOCK_SHINGLES)
    docs = docs.select("id", "c", "g", "part", F.pmod(F.xxhash64("id"), count).alias("nth"))
    packed = docs.join(texts, "id").groupBy("g", "part", "nth")
    schema = "g bigint, part bigint, nth bigint, ids binary, cs binary, first binary, sets binary"
    blocks = scratch.keep(packed.applyInPandas(_packer(shingle), schema), "blocks")

    keys = blocks.select("g", "part", "nth")
    one, two = (
        keys.select("g", *(F.col(c).alias(c + side) for c in ("part", "nth"))) for side in "ab"
    )
    pairs = one.join(two, "g").where(
        "(parta < partb OR (parta = partb AND ntha <= nthb)) AND (parta <> partb OR parta = -1)"
    )
    for side in "ab":
        named = [F.col(c).alias(c + side) for c in blocks.columns if c != "g"]
        pairs = pairs.join(blocks.select("g", *named), ["g", f"part{side}", f"nth{side}"])
    pairs = pairs.repartition("g", "parta", "ntha", "partb", "nthb")
    return pairs.mapInArrow(_block_links(percent), "a bigint, b bigint").distinct()


def _packer(shingle: int):
    def pack(rows: pd.DataFrame) -> pd.DataFrame:
        texts = pa.array(rows["text"], pa.large_string())
        ends, sets = [np.zeros(1, np.int64)], []
        for _, some in text_groups(texts):
            own, first = shingles_of(words_of(*text_bytes(some), space_separated()), shingle)
            ends.append(first[1:] + ends[-1][-1])
            sets.append(own)
        packed = rows[["g", "part", "nth"]].head(1).copy()
        packed["ids"] = [rows["id"].to_numpy(np.int64).tobytes()]
        packed["cs"] = [rows["c"].to_numpy(np.int64).tobytes()]
        packed["first"] = [np.concatenate(ends).tobytes()]
        packed["sets"] = [np.concatenate(sets).tobytes()]
        return packed

    return pack


def _block_links(percent: int):
    def unpack(batch: pa.RecordBatch, row: int, side: str):
        return [
            np.frombuffer(batch.column(c + side)[row].as_py(), kind)
            for c, kind in (("ids", np.int64), ("cs", np.int64), ("first", np.int64), ("sets", np.uint64))
        ]

    def common(first: np.ndarray, sets: np.ndarray, first2: np.ndarray, sets2: np.ndarray):
        """Sizes of all intersections, some shared shingles at a time."""
        shared = np.intersect1d(sets, sets2)
        sizes = np.zeros((len(first) - 1, len(first2) - 1), np.float64)
        sides = []
        for starts, members in ((first, sets), (first2, sets2)):
            owner = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
            place = np.searchsorted(shared, members)
            there = place < len(shared)
            there[there] = shared[place[there]] == members[there]
            order = np.argsort(place[there], kind="stable")
            sides.append((owner[there][order], place[there][order], len(starts) - 1))
        for low in range(0, len(shared), 4096):
            dense = []
            for owner, place, count in sides:
                part = slice(*np.searchsorted(place, [low, low + 4096]))
                matrix = np.zeros((count, 4096), np.float32)
                matrix[owner[part], place[part] - low] = 1
                dense.append(matrix)
            sizes += dense[0] @ dense[1].T
        return sizes

    def links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(len(batch)):
                ids, cs, first, sets = unpack(batch, row, "a")
                ids2, cs2, first2, sets2 = unpack(batch, row, "b")
                both = common(first, sets, first2, sets2)
                union = np.diff(first)[:, None] + np.diff(first2)[None, :] - both
                near = (both > 0) & (100 * both >= percent * union)
                i, j = np.nonzero(near & (cs[:, None] != cs2[None, :]))
                # One link of two components is as good as many.
                _, some = np.unique(np.stack((cs[i], cs2[j])), axis=1, return_index=True)
                i, j = i[some], j[some]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.minimum(ids[i], ids2[j])),
                        pa.array(np.maximum(ids[i], ids2[j])),
                    ],
                    ["a", "b"],
                )

    return links


def _confirmed(pairs: DataFrame, texts: DataFrame, shingle: int, percent: int) -> DataFrame:
    """The pairs ``a, b`` whose full sets are as similar as asked."""
    # Only texts of candidates travel, each once for every pair it is in.
    left = texts.select(F.col("id").alias("a"), F.col("text").alias("left"))
    right = texts.select(F.col("id").alias("b"), F.col("text").alias("right"))
    both = pairs.join(left, "a").join(right, "b")

    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, lefts in text_groups(batch.column("left"), 4 << 20):
                rows = batch.slice(at, len(lefts))
                rights = rows.column("right").cast(pa.large_string()).fill_null("")
                x, fx = shingles_of(words_of(*text_bytes(lefts), space_separated()), shingle)
                y, fy = shingles_of(words_of(*text_bytes(rights), space_separated()), shingle)
                keep = []
                for i in range(len(rows)):
                    one, two = x[fx[i] : fx[i + 1]], y[fy[i] : fy[i + 1]]
                    all_ = np.concatenate((one, two))
                    all_.sort()
                    common = int((all_[1:] == all_[:-1]).sum())
                    union = len(all_) - common
                    keep.append(common > 0 and 100 * common >= percent * union)
                yield rows.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return both.mapInArrow(confirm, "a bigint, b bigint").distinct()
