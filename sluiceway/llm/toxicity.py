"""Score texts for toxicity with a naive-Bayes-scaled linear classifier of character n-grams.

A feature is whether a hashed n-gram of characters (A-Z lower-cased, white space as one kind
of space) occurs in a text. Its value is the log ratio of how often it occurs in toxic and
in other texts, and a logistic regression learns a weight for each of these values. Only
the ``FEATURES`` n-grams that differ most between the classes are kept.

The classifier is fitted on at most about ``MAX_ROWS`` labelled rows, half of them toxic if
there are enough, chosen by the hash of the document id and weighted so that the sample
stands for all labelled rows. Counts of n-grams are made on the executors; the driver gets
the kept features of the sample. Scores cover all characters of all texts.

Defined results: a NULL text is empty; the empty text gets the score of a text without
features. Label rows with a NULL id or a class other than 0 or 1 are ignored, several labels
of one document all count. With no labels that match a document, or of one class only, every
score is the share of toxic labels, smoothed, and no document is dropped. Rows are scored by themselves, so ties, repeated rows and NULL ids
need no rule. An empty table gives an empty result. Other columns may have any name.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluiceway.llm.frames import col, text_groups

ORDERS = (4, 5)
BITS = 20
MAX_ROWS = 20_000
FEATURES = 50_000
#: Standard errors that a feature's log ratio must be away from 0.
MIN_STRENGTH = 3.0
#: The least log ratio, of either sign: 1.6 times as frequent in one class. Without it held-out
#: recall is the same and the fit takes longer, see the README.
MIN_RATIO = 0.5
STEPS, PENALTY = 300, 1.0
#: Features of the sample that a step of the fit works on at once.
CHUNK = 1 << 20


def _characters(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all texts, folded, and where each text begins."""
    parts = texts.to_pylist()
    offsets = np.concatenate(([0], np.cumsum([len(p) for p in parts], dtype=np.int64)))
    codes = np.frombuffer("".join(parts).encode("utf-32-le"), np.uint32).copy()
    fold = np.arange(128, dtype=np.uint32)
    fold[0x41:0x5B] += 32
    fold[0x09:0x0E] = 0x20
    ascii_ = codes < 128
    codes[ascii_] = fold[codes[ascii_]]
    return codes, offsets


def _buckets(codes: np.ndarray, order: int) -> np.ndarray:
    """The bucket of the n-gram at each place."""
    count = max(len(codes) - order + 1, 0)
    h = np.full(count, order, np.uint32)
    for k in range(order):
        h *= np.uint32(0x01000193)
        h ^= codes[k : count + k]
    h ^= h >> np.uint32(15)
    h *= np.uint32(0x85EBCA6B)
    h ^= h >> np.uint32(13)
    h *= np.uint32(0xC2B2AE35)
    return h >> np.uint32(32 - BITS)


def _present(texts: pa.Array, wanted: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """Which text has which bucket, each pair once; only wanted buckets if given."""
    codes, offsets = _characters(texts)
    pairs = []
    for order in ORDERS:
        buckets = _buckets(codes, order)
        at = np.arange(len(buckets)) if wanted is None else np.flatnonzero(wanted[buckets])
        text = np.searchsorted(offsets, at, "right") - 1
        inside = at + order <= offsets[text + 1]
        pairs.append(text[inside] << BITS | buckets[at[inside]].astype(np.int64))
    pairs = np.unique(np.concatenate(pairs))
    return pairs >> BITS, pairs & ((1 << BITS) - 1)


class ToxicityModel:
    """A bias, and the weight of each bucket (0 for buckets that are no features). It is
    ``informed`` if it was fitted on texts of both classes."""

    def __init__(self, bias: float, buckets: np.ndarray, weights: np.ndarray, informed: bool = True):
        self.bias, self.buckets, self.weights, self.informed = bias, buckets, weights, informed

    def dense(self) -> tuple[np.ndarray, np.ndarray]:
        weights = np.zeros(1 << BITS, np.float64)
        weights[self.buckets] = self.weights
        return weights, weights != 0


def _sample(labels: DataFrame, id_col: str, label_col: str, learn: Column) -> tuple[DataFrame, dict]:
    """At most about ``MAX_ROWS`` labels, and for each class how many rows one stands for."""
    rows = labels.select(
        col(id_col).cast("bigint").alias("id"), col(label_col).cast("int").alias("label")
    ).where(F.col("label").isin(0, 1) & F.col("id").isNotNull() & learn)
    counts = {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}
    few = min(counts.values(), default=0)
    share = {c: min(1.0, max(MAX_ROWS / 2, MAX_ROWS - few) / n) for c, n in counts.items()}
    place = F.pmod(F.xxhash64("id", F.lit(8)), F.lit(1 << 30)) / float(1 << 30)
    chosen = F.lit(False)
    for label, part in share.items():
        chosen = chosen | ((F.col("label") == label) & (place < part))
    # The limit makes the bound of the broadcast certain.
    return rows.where(chosen).limit(2 * MAX_ROWS), {c: 1 / s for c, s in share.items()}


def fit_toxicity(
    documents: DataFrame,
    labels: DataFrame,
    learn: Column | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
) -> ToxicityModel:
    """Fit on the labelled documents; ``learn`` is a condition on their ``id``."""
    learn = F.lit(True) if learn is None else learn
    sample, stands_for = _sample(labels, id_col, label_col, learn)
    texts = documents.select(
        col(id_col).cast("bigint").alias("id"), col(text_col).cast("string").alias("text")
    )
    rows = texts.join(F.broadcast(sample), "id").select("text", "label")
    # Labels may be of other documents, so the classes are counted where both are known.
    counts = {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}
    if len(counts) < 2:
        share = (counts.get(1, 0) + 1) / (sum(counts.values()) + 2)
        none = np.zeros(0)
        return ToxicityModel(float(np.log(share / (1 - share))), none.astype(np.int64), none, False)
    buckets, ratios = _ratios(rows, counts)
    return _regress(rows, buckets, ratios, stands_for)


def _ratios(rows: DataFrame, totals: dict[int, int]) -> tuple[np.ndarray, np.ndarray]:
    """The strongest features, with the log ratio of their shares in both classes."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((2, 1 << BITS), np.int32)
        for batch in batches:
            label = batch.column("label").to_numpy(False)
            for at, texts in text_groups(batch.column("text"), 2 << 20):
                text, bucket = _present(texts, None)
                for c in (0, 1):
                    counts[c] += np.bincount(
                        bucket[label[at + text] == c], minlength=1 << BITS
                    ).astype(np.int32)
        some = np.flatnonzero(counts.any(0))
        yield pa.RecordBatch.from_arrays(
            [pa.array(some.astype(np.int32)), pa.array(counts[0][some]), pa.array(counts[1][some])],
            ["bucket", "n0", "n1"],
        )

    counted = rows.mapInArrow(count, "bucket int, n0 int, n1 int").groupBy("bucket")
    counted = counted.agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))
    toxic = (F.col("n1") + 1) / (totals[1] + 2)
    other = (F.col("n0") + 1) / (totals[0] + 2)
    # How many standard errors the ratio is away from none.
    strength = F.abs(F.col("ratio")) / F.sqrt(1 / (F.col("n1") + 1) + 1 / (F.col("n0") + 1))
    best = (
        counted.withColumn("ratio", F.log(toxic / other))
        .select("bucket", "ratio", strength.alias("strength"))
        .where((F.col("strength") >= MIN_STRENGTH) & (F.abs("ratio") >= MIN_RATIO))
        .orderBy(F.desc("strength"), "bucket")
        .limit(FEATURES)
        .toPandas()
    )
    return best["bucket"].to_numpy(np.int64), best["ratio"].to_numpy(float)


def _regress(
    rows: DataFrame, buckets: np.ndarray, ratios: np.ndarray, stands_for: dict
) -> ToxicityModel:
    wanted = np.zeros(1 << BITS, bool)
    wanted[buckets] = True
    place = np.zeros(1 << BITS, np.int32)
    place[buckets] = np.arange(len(buckets))
    shared = rows.sparkSession.sparkContext.broadcast((wanted, place))

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted, place = shared.value
        for batch in batches:
            for at, texts in text_groups(batch.column("text")):
                text, bucket = _present(texts, wanted)
                ends = np.searchsorted(text, np.arange(len(texts) + 1))
                columns = place[bucket]
                found = [columns[a:b].tobytes() for a, b in zip(ends[:-1], ends[1:])]
                labels = batch.column("label")[at : at + len(texts)]
                yield pa.RecordBatch.from_arrays(
                    [labels, pa.array(found, pa.binary())], ["label", "found"]
                )

    table = rows.mapInArrow(features, "label int, found binary").toArrow()
    y = table["label"].to_numpy().astype(float)
    found = table["found"].combine_chunks().cast(pa.large_binary())
    _, bounds, data = found.buffers()
    ends = np.frombuffer(bounds, np.int64, len(found) + 1, 8 * found.offset) // 4
    column = np.frombuffer(data, np.int32) if data is not None else np.zeros(0, np.int32)
    importance = np.where(y == 1, stands_for[1], stands_for[0])
    # Texts that are worked on together, so that memory holds little but the features.
    cuts = np.unique(np.searchsorted(ends, np.arange(0, ends[-1] + CHUNK, CHUNK)).clip(0, len(y)))
    cuts = np.unique(np.concatenate(([0], cuts, [len(y)])))
    weights = np.full(len(ratios), 0.1)
    bias = float(np.log((importance @ y + 1) / (importance @ (1 - y) + 1)))
    moments = [np.zeros(len(weights) + 1) for _ in range(2)]
    for step in range(1, STEPS + 1):  # full-batch gradient descent with momentum per weight
        gradient = np.append(PENALTY * weights, 0.0)
        for low, high in zip(cuts[:-1], cuts[1:]):
            own = column[ends[low] : ends[high]]
            row = np.repeat(np.arange(high - low), np.diff(ends[low : high + 1]))
            margin = bias + np.bincount(row, (weights * ratios)[own], high - low)
            error = 1 / (1 + np.exp(-np.clip(margin, -40, 40))) - y[low:high]
            error *= importance[low:high]
            gradient[:-1] += ratios * np.bincount(own, error[row], len(weights))
            gradient[-1] += error.sum()
        moments[0] = 0.9 * moments[0] + 0.1 * gradient
        moments[1] = 0.99 * moments[1] + 0.01 * gradient**2
        change = moments[0] / (1 - 0.9**step) / (np.sqrt(moments[1] / (1 - 0.99**step)) + 1e-9)
        rate = 0.05 * (1 - step / (STEPS + 1))
        weights -= rate * change[:-1]
        bias -= rate * change[-1]
    return ToxicityModel(bias, buckets, weights * ratios)


def with_score(
    documents: DataFrame, model: ToxicityModel, text_col: str, keep: list[str]
) -> DataFrame:
    """``kept``, a struct of the columns to keep, and ``score``."""
    shared = documents.sparkSession.sparkContext.broadcast((model.bias, *model.dense()))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bias, weights, wanted = shared.value
        for batch in batches:
            for at, texts in text_groups(batch.column("text")):
                row, bucket = _present(texts, wanted)
                margin = bias + np.bincount(row, weights[bucket], len(texts))
                scores = 1 / (1 + np.exp(-np.clip(margin, -40, 40)))
                kept = batch.column("kept")[at : at + len(texts)]
                yield pa.RecordBatch.from_arrays([kept, pa.array(scores)], ["kept", "score"])

    rows = documents.select(
        F.struct(*(col(c) for c in keep)).alias("kept"),
        col(text_col).cast("string").alias("text"),
    )
    return rows.mapInArrow(score, T.StructType([rows.schema["kept"]]).add("score", "double"))


def toxicity_report(
    documents: DataFrame,
    labels: DataFrame,
    learn: Column | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
) -> DataFrame:
    """``doc_id, score, predicted`` of every row."""
    model = fit_toxicity(documents, labels, learn, id_col, text_col, label_col)
    scored = with_score(documents, model, text_col, [id_col])
    predicted = (F.col("score") >= 0.5).cast("int").alias("predicted")
    return scored.select(F.col("kept").getField(id_col).alias("doc_id"), "score", predicted)


def drop_toxic(
    documents: DataFrame,
    labels: DataFrame,
    learn: Column | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
) -> DataFrame:
    """``documents`` without those that are predicted to be toxic.

    If the labelled documents are not of both classes nothing is known, and all stay.
    """
    model = fit_toxicity(documents, labels, learn, id_col, text_col, label_col)
    if not model.informed:
        return documents
    clean = with_score(documents, model, text_col, documents.columns).where("score < 0.5")
    return clean.select(*(F.col("kept").getField(c).alias(c) for c in documents.columns))
