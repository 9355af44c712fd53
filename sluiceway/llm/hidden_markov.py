"""Score texts with a hidden Markov language model trained by Baum-Welch on Spark.

A text is its words, A-Z lower-cased, and one end. Hidden states follow one another by a
transition matrix. A state emits the class of a token, and the class the token itself:

- The most frequent tokens, ``OWN_CLASSES`` at most, are classes of their own. All others share a class
  with the words of the same ending, one of ``ENDINGS`` by hash.
- Within a class of endings a token has its share of the class's count in all training texts,
  less a discount. What the discounts leave is the probability of a word of that class that
  training has not seen, so the model is a proper distribution over known tokens and one unseen
  word of each class.

So the parameters of the states are bounded by the classes, while counts of words are a table
as large as the vocabulary, which is aggregated and joined on the executors.

1. Texts are taken in chunks of some megabytes. Each chunk writes its distinct words with their
   counts once, and its texts as numbers of these words.
2. Words are counted over all training texts. The counts are joined to each chunk's words, and
   meet the chunk's texts in one group a chunk, which a hot word or source does not make larger.
   Texts become sequences of classes.
3. Each iteration of Baum-Welch runs forward and backward over all training sequences. Tasks add
   up expected counts of starts, transitions and (class, state); these are summed over all
   partitions, and the driver, which holds nothing else, normalises them.
4. The likelihood of each text is that of the scaled forward recursion over the whole text.

Recursions take many texts at once, step by step. Texts of more than ``SEGMENT`` tokens are cut
into segments that run side by side from every state; the segments' matrices are then chained,
which gives the same result as one recursion.

Defined results: NULL counts as the empty text, which is an end alone. A NULL id counts as the
empty text where its remainder is taken. Rows are scored by themselves, repeated rows and rows
that share an id too. Words of more than ``LONGEST`` bytes are known by a hash of 256 bits. If
there are no training texts nothing is known: the base score is 0 and all classes are alike. An
empty table gives an empty result. Only the two named columns are read.
"""

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluiceway.codecs.pieces import Pieces, varints
from sluiceway.llm.frames import Scratch, col, text_bytes, text_groups
from sluiceway.llm.terms import terms_of
from sluiceway.llm.words import space_separated

STATES, ITERATIONS = 8, 4
OWN_CLASSES, ENDINGS, ENDING_BYTES = 1 << 14, 1 << 12, 3
CHUNK_BYTES = 12 << 20
LONGEST = 64
SEGMENT, TOKENS_AT_ONCE = 2048, 1 << 18
#: Examples that speak for the classes' overall shares in each state.
PRIOR = 100.0
#: The key of the end of a text: no word is empty.
END = b""

ENCODED = "chunk bigint, id bigint, learn boolean, codes binary, words array<binary>, counts array<bigint>"
SEQUENCES = (
    "id bigint, learn boolean, n_tokens bigint, n_known bigint, base double, inner double, classes binary"
)


def encode(documents: DataFrame) -> DataFrame:
    """Texts (``chunk, id, learn, codes``) and vocabularies (``chunk, words, counts``) of chunks.

    ``documents`` has ``id, learn, text``. Codes are places in the chunk's vocabulary, which
    begins with the end, as varints. Counts are those in texts to learn from.
    """
    member = space_separated()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk = TaskContext.get().partitionId() << 32
        for batch in batches:
            for at, texts in text_groups(batch.column("text"), CHUNK_BYTES):
                rows = batch.slice(at, len(texts))
                learn = rows.column("learn").to_numpy(False).astype(bool)
                terms, first = terms_of(*text_bytes(texts), member)
                coded = terms.dictionary_encode()
                del terms
                # The end is 0 and frequent words follow, as small numbers take few bytes.
                uses = np.bincount(coded.indices, minlength=len(coded.dictionary))
                order = np.argsort(-uses, kind="stable")
                number = np.empty(len(order), np.int32)
                number[order] = np.arange(1, len(order) + 1)
                codes = np.insert(number[coded.indices], first[1:], 0)
                first = first + np.arange(len(first))
                taken = np.repeat(learn, np.diff(first))
                counts = np.bincount(codes[taken], minlength=len(order) + 1)
                words = _keys(coded.dictionary.take(pa.array(order)))
                words = pa.concat_arrays([pa.array([END], pa.binary()), words])
                n = len(texts)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(n, chunk)), rows.column("id"), rows.column("learn"),
                        varints(codes).joined(first).binary(),
                        pa.nulls(n, pa.list_(pa.binary())), pa.nulls(n, pa.list_(pa.int64())),
                    ],
                    ["chunk", "id", "learn", "codes", "words", "counts"],
                )
                bounds = pa.array([0, len(words)], pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([chunk]), pa.nulls(1, pa.int64()), pa.nulls(1, pa.bool_()),
                        pa.nulls(1, pa.binary()),
                        pa.ListArray.from_arrays(bounds, words),
                        pa.ListArray.from_arrays(bounds, pa.array(counts.astype(np.int64))),
                    ],
                    ["chunk", "id", "learn", "codes", "words", "counts"],
                )
                chunk += 1

    return documents.mapInArrow(run, ENCODED)


def numbers_of(packed: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All numbers in strings of varints, below 2^28, and where those of each string begin."""
    wide = packed.cast(pa.large_binary())
    offsets = np.frombuffer(wide.buffers()[1], np.int64, len(wide) + 1, 8 * wide.offset)
    data = np.frombuffer(wide.buffers()[2], np.uint8)[offsets[0] : offsets[-1]] if offsets[-1] else np.zeros(0, np.uint8)
    end = np.flatnonzero(data < 0x80)
    start = np.concatenate(([0], end[:-1] + 1)) if len(end) else end
    numbers = (data[start] & 0x7F).astype(np.int64)
    for group in range(1, int((end - start).max(initial=0)) + 1):
        longer = np.flatnonzero(end - start >= group)
        numbers[longer] |= (data[start[longer] + group] & 0x7F).astype(np.int64) << (7 * group)
    return numbers, np.searchsorted(start, offsets - offsets[0])


def _keys(words: pa.Array) -> pa.Array:
    """Words as keys: long ones as a blank, which no word has, and their hash."""
    long = np.flatnonzero(pc.binary_length(words).to_numpy() > LONGEST)
    if len(long):
        short = words.to_pylist()
        for i in long.tolist():
            short[i] = b" " + hashlib.sha256(short[i]).digest()
        words = pa.array(short, pa.large_binary())
    return words.cast(pa.binary())


@dataclass
class Vocabulary:
    """Classes and what is known of them: bounded, whatever the corpus."""

    tokens: int  # all, in training
    kinds: int  # distinct ones
    discount: float
    own: pa.Array  # the most frequent tokens; each place is a class
    size: np.ndarray  # training tokens of each class
    seen: np.ndarray  # distinct ones

    @property
    def share(self) -> np.ndarray:
        return (self.size + 0.5) / (self.tokens + 0.5 * len(self.size))


def ending(word: str) -> Column:
    """The class of a word that has none of its own."""
    return F.expr(f"{OWN_CLASSES} + crc32(substring({word}, -{ENDING_BYTES}, {ENDING_BYTES})) % {ENDINGS}")


def _classes(words: DataFrame, own: DataFrame) -> DataFrame:
    """``words`` with their ``class``. ``own`` has ``OWN_CLASSES`` rows at most."""
    known = words.join(F.broadcast(own), "word", "left")
    return known.withColumn("class", F.coalesce("place", ending("word")).cast("int")).drop("place")


def vocabulary_of(counts: DataFrame) -> tuple[Vocabulary, DataFrame]:
    """The vocabulary, and the tokens with a class of their own as ``word, place``.

    ``counts`` has ``word, c``.
    """
    of = lambda n: F.sum((F.col("c") == n).cast("bigint"))
    total = counts.agg(F.sum("c").alias("n"), F.count(F.lit(1)).alias("v"), of(1).alias("n1"), of(2).alias("n2"))
    n, v, n1, n2 = (x or 0 for x in total.head())
    # Words from a count on that at most OWN_CLASSES words reach. Each count has a word at least, so
    # the highest OWN_CLASSES counts tell, and no more rows than that reach the driver.
    heights = counts.groupBy("c").agg(F.count(F.lit(1)).alias("words"))
    heights = heights.orderBy(F.desc("c")).limit(OWN_CLASSES).toPandas()
    least = heights["c"][heights["words"].cumsum() <= OWN_CLASSES].min()
    frequent = counts.where(F.lit(False) if np.isnan(least) else F.col("c") >= int(least))
    own = frequent.toArrow().sort_by([("c", "descending"), ("word", "ascending")])["word"].combine_chunks()
    places = pa.table({"word": own, "place": pa.array(np.arange(len(own)), pa.int32())})
    places = counts.sparkSession.createDataFrame(places)
    classes = _classes(counts, places).groupBy("class").agg(F.sum("c").alias("size"), F.count(F.lit(1)).alias("seen"))
    size, seen = np.zeros(OWN_CLASSES + ENDINGS), np.zeros(OWN_CLASSES + ENDINGS)
    for row in classes.collect():
        size[row["class"]], seen[row["class"]] = row["size"], row["seen"]
    discount = float(np.clip(n1 / (n1 + 2 * n2), 0.1, 0.9)) if n1 else 0.5
    return Vocabulary(n, v, discount, own, size, seen), places


def sequences(encoded: DataFrame, counts: DataFrame, own: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """Every text as classes, with the sums over its tokens that need the counts of words."""
    words = _exploded(encoded)
    known = _classes(words.select("chunk", "code", "word").join(counts, "word", "left"), own)
    known = known.select("chunk", "code", "class", F.coalesce("c", F.lit(0).cast("bigint")).alias("c"))
    texts = encoded.where("codes IS NOT NULL")
    texts = texts.select(F.col("chunk").alias("of"), "id", "learn", "codes")
    v = vocabulary
    size, seen, discount = v.size, v.seen, v.discount
    below = v.tokens + 0.5 * (v.kinds + 1)

    def run(words: pa.Table, texts: pa.Table) -> pa.Table:
        place = np.argsort(words["code"].to_numpy())
        c = words["c"].to_numpy()[place]
        kind = words["class"].to_numpy()[place]
        base = np.log10((c + 0.5) / below)
        inner = np.zeros(len(c))
        shared = np.flatnonzero((kind >= OWN_CLASSES) & (size[kind] > 0))
        within = np.where(c > 0, c - discount, discount * seen[kind])
        inner[shared] = np.log10(within[shared] / size[kind[shared]])
        codes, first = numbers_of(texts["codes"].combine_chunks())
        # Every text has a token, its end, so no sum is over nothing.
        total = lambda values: pa.array(np.add.reduceat(values[codes], first[:-1]))
        classes = Pieces(kind[codes].astype(np.uint16).view(np.uint8), 2 * first.astype(np.int64))
        return pa.table(
            {
                "id": texts["id"], "learn": texts["learn"],
                "n_tokens": pa.array(np.diff(first).astype(np.int64)),
                "n_known": total((c > 0).astype(np.int64)),
                "base": total(base), "inner": total(inner), "classes": classes.binary(),
            }
        )

    return known.groupBy("chunk").cogroup(texts.groupBy("of")).applyInArrow(run, SEQUENCES)


def _exploded(encoded: DataFrame) -> DataFrame:
    """``chunk, code, word, n`` of all chunks' vocabularies."""
    zipped = F.posexplode(F.arrays_zip("words", "counts"))
    words = encoded.where("words IS NOT NULL").select("chunk", zipped.alias("code", "entry"))
    return words.select("chunk", "code", F.col("entry.words").alias("word"), F.col("entry.counts").alias("n"))


@dataclass
class Chain:
    """Start, transition and emission probabilities; ``emit`` has a row for each class."""

    start: np.ndarray
    move: np.ndarray
    emit: np.ndarray

    @cached_property
    def by_state(self) -> np.ndarray:
        """Emission probabilities with a row for each state."""
        return np.ascontiguousarray(self.emit.T)


def first_chain(vocabulary: Vocabulary, states: int) -> Chain:
    """States that stay, with shares of classes changed at random, the same in every run."""
    drawn = np.random.default_rng(12).uniform(0.25, 1.75, (OWN_CLASSES + ENDINGS, states))
    emit = vocabulary.share[:, None] * drawn
    move = np.full((states, states), 0.1 / max(states - 1, 1)) if states > 1 else np.ones((1, 1))
    if states > 1:
        np.fill_diagonal(move, 0.9)
    return Chain(np.full(states, 1 / states), move, emit / emit.sum(0))


def next_chain(vocabulary: Vocabulary, start: np.ndarray, moves: np.ndarray, emitted: np.ndarray) -> Chain:
    """The chain that expected counts give, drawn a little to the overall shares."""
    emit = emitted + PRIOR * vocabulary.share[:, None]
    moves, start = moves + 1.0, start + 1.0
    return Chain(start / start.sum(), moves / moves.sum(1, keepdims=True), emit / emit.sum(0))


class Segments:
    """Sequences cut into segments of at most ``SEGMENT`` tokens, one after the other."""

    def __init__(self, parts: list[np.ndarray]):
        self.tokens = np.concatenate(parts) if parts else np.zeros(0, np.uint16)
        ends = np.cumsum([len(p) for p in parts], dtype=np.int64)
        counts = [-(-len(p) // SEGMENT) for p in parts]
        #: The segments of sequence i are ``first[i]:first[i + 1]``.
        self.first = np.concatenate(([0], np.cumsum(counts, dtype=np.int64)))
        begins = [np.arange(e - len(p), e, SEGMENT) for p, e in zip(parts, ends.tolist())]
        self.begin = np.concatenate(begins) if begins else np.zeros(0, np.int64)
        stops = np.append(self.begin[1:], len(self.tokens))
        self.size = stops - self.begin

    def batches(self, chosen: np.ndarray, copies: int) -> Iterator[np.ndarray]:
        """Chosen segments, the longest first, some at a time, each ``copies`` times."""
        order = chosen[np.argsort(-self.size[chosen], kind="stable")]
        load = np.cumsum(self.size[order] * copies)
        cuts = np.unique(np.searchsorted(load, np.arange(0, load[-1], TOKENS_AT_ONCE))) if len(load) else []
        for low, high in zip(cuts, [*cuts[1:], len(order)]):
            yield np.repeat(order[low:high], copies)


def _steps(segments: Segments, rows: np.ndarray) -> tuple[np.ndarray, list[tuple[int, int]]]:
    """Tokens of segments (longest first) in order of their place within them, and the bounds of
    each place. The segments that have a place are the first ones."""
    begin, size = segments.begin[rows], segments.size[rows]
    longest = int(size[0]) if len(size) else 0
    active = np.searchsorted(-size, -np.arange(longest), "left")
    ends = np.cumsum(active)
    at = np.empty(ends[-1] if longest else 0, np.int64)
    bounds = list(zip((ends - active).tolist(), ends.tolist()))
    for t, (low, high) in enumerate(bounds):
        np.add(begin[: high - low], t, out=at[low:high])
    return segments.tokens[at], bounds


def _forward(chain: Chain, emitted: np.ndarray, bounds: list, v: np.ndarray):
    """Run segments from distributions ``v`` of the first state, on the emission probabilities of
    their tokens, which become the distributions of the states that emitted them. Both have a row
    for each state, so that numpy works along many segments at once.

    Returns the distributions after the last token and the logarithms of the segments'
    probabilities.
    """
    v = v.copy()
    log = np.zeros(v.shape[1])
    back = np.ascontiguousarray(chain.move.T)
    for low, high in bounds:
        alpha = emitted[:, low:high]
        alpha *= v[:, : high - low]
        total = alpha.sum(0)
        alpha /= total
        log[: high - low] += np.log(total)
        v[:, : high - low] = back @ alpha
    return v, log


def _emissions(chain: Chain, tokens: np.ndarray) -> np.ndarray:
    """The probability of each token in each state, a row for each state."""
    return np.take(chain.by_state, tokens, axis=1)


def _matrices(chain: Chain, segments: Segments) -> tuple[np.ndarray, np.ndarray]:
    """For every segment of a cut sequence but the first: the state after it from each state
    before it, and the logarithm of its probability."""
    states = len(chain.start)
    later = np.ones(len(segments.begin), bool)
    later[segments.first[:-1]] = False
    ends, logs = np.zeros((len(later), states, states)), np.zeros((len(later), states))
    for rows in segments.batches(np.flatnonzero(later), states):
        tokens, bounds = _steps(segments, rows)
        v, log = _forward(chain, _emissions(chain, tokens), bounds, np.tile(np.eye(states), len(rows) // states))
        own = rows[::states]
        ends[own], logs[own] = v.T.reshape(-1, states, states), log.reshape(-1, states)
    return ends, logs


def log_likelihoods(chain: Chain, parts: list[np.ndarray]) -> np.ndarray:
    """The natural logarithm of the probability of the classes of each sequence."""
    segments = Segments(parts)
    states = len(chain.start)
    heads = segments.first[:-1]
    after, total = np.zeros((len(segments.begin), states)), np.zeros(len(segments.begin))
    for rows in segments.batches(heads, 1):
        tokens, bounds = _steps(segments, rows)
        start = np.tile(chain.start[:, None], len(rows))
        v, total[rows] = _forward(chain, _emissions(chain, tokens), bounds, start)
        after[rows] = v.T
    result = total[heads].copy()
    if len(segments.begin) > len(heads):
        ends, logs = _matrices(chain, segments)
        for i in np.flatnonzero(np.diff(segments.first) > 1).tolist():
            v = after[heads[i]]
            for s in range(heads[i] + 1, segments.first[i + 1]):
                v, log = _passed(v, ends[s], logs[s])
                result[i] += log
    return result


def _passed(v: np.ndarray, ends: np.ndarray, logs: np.ndarray) -> tuple[np.ndarray, float]:
    """A distribution of states put through a segment's matrix."""
    top = logs.max()
    weight = v * np.exp(logs - top)
    return weight @ ends / weight.sum(), top + np.log(weight.sum())


def expected_counts(chain: Chain, parts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, moves and emissions of each class that sequences are expected to have."""
    segments = Segments(parts)
    states, count = len(chain.start), len(segments.begin)
    before, behind = np.tile(chain.start, (count, 1)), np.ones((count, states))
    heads = segments.first[:-1]
    cut = np.flatnonzero(np.diff(segments.first) > 1)
    if len(cut):
        ends, logs = _matrices(chain, segments)
        for own in segments.batches(heads[cut], 1):
            tokens, bounds = _steps(segments, own)
            v, _ = _forward(chain, _emissions(chain, tokens), bounds, before[own].T)
            before[own + 1] = v.T
        for i in cut.tolist():
            low, high = segments.first[i], segments.first[i + 1]
            for s in range(low + 1, high - 1):
                before[s + 1], _ = _passed(before[s], ends[s], logs[s])
            for s in range(high - 1, low, -1):
                u = np.exp(logs[s] - logs[s].max()) * (ends[s] @ behind[s])
                behind[s - 1] = u / u.sum() * states
    last = np.zeros(count, bool)
    last[segments.first[1:] - 1] = True
    start, moves = np.zeros(states), np.zeros((states, states))
    emitted = np.zeros(chain.emit.shape)
    for rows in segments.batches(np.arange(count), 1):
        tokens, bounds = _steps(segments, rows)
        emit = _emissions(chain, tokens)
        gammas = emit.copy()
        _forward(chain, gammas, bounds, before[rows].T)
        size, u = segments.size[rows], np.ascontiguousarray(behind[rows].T)
        goes_on = ~last[rows]
        for t in range(len(bounds) - 1, -1, -1):
            low, high = bounds[t]
            n = high - low
            alpha = gammas[:, low:high]
            ahead = chain.move @ u[:, :n]
            weight = 1 / (alpha * ahead).sum(0)
            # The last token of a sequence is not followed by a move.
            follows = alpha * (weight * (goes_on[:n] | (size[:n] > t + 1)))
            moves += follows @ u[:, :n].T
            alpha *= ahead
            alpha *= weight
            ahead *= emit[:, low:high]
            ahead /= ahead.sum(0)
            u[:, :n] = ahead
        start += gammas[:, : len(rows)][:, np.isin(rows, heads)].sum(1)
        for k in range(states):
            emitted[:, k] += np.bincount(tokens, gammas[k], len(emitted))
    return start, moves * chain.move, emitted


def _parts(classes: pa.Array) -> list[np.ndarray]:
    return [np.frombuffer(c.as_buffer(), np.uint16) for c in classes]


def _groups(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Slices of a batch of about eight times ``TOKENS_AT_ONCE``."""
    load = np.cumsum(batch.column("n_tokens").to_numpy()) // (8 * TOKENS_AT_ONCE)
    cuts = np.flatnonzero(np.diff(load, prepend=-1))
    for low, high in zip(cuts, np.append(cuts[1:], len(load))):
        yield batch.slice(low, high - low)


def train(texts: DataFrame, vocabulary: Vocabulary, states: int, iterations: int) -> Chain:
    """Baum-Welch over all sequences to learn from; ``texts`` is a table of sequences."""
    spark = texts.sparkSession
    chain = first_chain(vocabulary, states)
    learned = texts.where("learn").select("n_tokens", "classes")
    names = [f"s{k}" for k in range(states)]
    for _ in range(iterations):
        shared = spark.sparkContext.broadcast(chain)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            chain = shared.value
            start, moves = np.zeros(states), np.zeros((states, states))
            emitted = np.zeros(chain.emit.shape)
            for batch in batches:
                for part in _groups(batch):
                    own = expected_counts(chain, _parts(part.column("classes")))
                    start, moves, emitted = start + own[0], moves + own[1], emitted + own[2]
            # Classes from 0; then a row of moves for each state, and the starts.
            some = np.flatnonzero(emitted.any(1))
            place = np.concatenate((some, len(emitted) + np.arange(states + 1)))
            table = np.concatenate((emitted[some], moves, start[None]))
            columns = [pa.array(place.astype(np.int32)), *(pa.array(table[:, k]) for k in range(states))]
            yield pa.RecordBatch.from_arrays(columns, ["place", *names])

        schema = "place int, " + ", ".join(f"{name} double" for name in names)
        counted = learned.mapInArrow(run, schema).groupBy("place")
        counted = counted.agg(*(F.sum(name).alias(name) for name in names)).toArrow()
        total = np.zeros((len(chain.emit) + states + 1, states))
        total[counted["place"].to_numpy()] = np.stack([counted[name].to_numpy() for name in names], 1)
        emitted, moves, start = np.split(total, [len(chain.emit), len(chain.emit) + states])
        chain = next_chain(vocabulary, start[0], moves, emitted)
        shared.unpersist()
    return chain


def with_likelihood(texts: DataFrame, chain: Chain) -> DataFrame:
    """``id, learn, n_tokens, n_known, base, score`` of sequences, scores in base 10."""
    shared = texts.sparkSession.sparkContext.broadcast(chain)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _groups(batch):
                log = log_likelihoods(shared.value, _parts(part.column("classes"))) / np.log(10)
                score = pa.array(part.column("inner").to_numpy() + log)
                columns = [part.column(c) for c in ("id", "learn", "n_tokens", "n_known", "base")]
                yield pa.RecordBatch.from_arrays([*columns, score], [*kept, "score"])

    kept = ["id", "learn", "n_tokens", "n_known", "base"]
    schema = "id bigint, learn boolean, n_tokens bigint, n_known bigint, base double, score double"
    return texts.mapInArrow(run, schema)


def likelihood_report(
    documents: DataFrame,
    learn: Column | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    states: int = STATES,
    iterations: int = ITERATIONS,
) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` of every row.

    ``learn`` is a condition on the column ``id``; by default all rows are learned from.
    """
    scratch = Scratch(documents.sparkSession)
    learn = F.lit(True) if learn is None else F.coalesce(learn, F.lit(False))
    rows = documents.select(
        col(id_col).cast("bigint").alias("id"),
        F.coalesce(col(text_col).cast("string"), F.lit("")).alias("text"),
    ).select("id", learn.alias("learn"), "text")
    encoded = scratch.keep(encode(rows), "encoded")
    counts = _exploded(encoded).where("n > 0").groupBy("word").agg(F.sum("n").alias("c"))
    counts = scratch.keep(counts, "counts")
    vocabulary, own = vocabulary_of(counts)
    texts = scratch.keep(sequences(encoded, counts, own, vocabulary), "sequences")
    scratch.drop("encoded")
    scored = with_likelihood(texts, train(texts, vocabulary, states, iterations))
    return scored.select(
        F.col("id").alias("doc_id"),
        (~F.col("learn")).alias("held_out"),
        "n_tokens",
        "n_known",
        F.lit(vocabulary.tokens).cast("bigint").alias("train_tokens"),
        F.col("base").alias("base_score"),
        "score",
    )
