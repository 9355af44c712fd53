"""Language of a text by a bidirectional gated recurrent network over its bytes.

The network reads a text in segments of ``SEGMENT`` bytes, forwards and backwards, gives
every byte's position the probabilities of the languages, and a text the mean over all its
positions. It is trained in numpy by backpropagation through time, every position being
labelled with the language of its document, on at most about ``DOCUMENTS_PER_LANGUAGE``
documents of each language (chosen by the hash of their id) and ``SEGMENTS_PER_DOCUMENT``
segments of each, spread over the whole text. Prediction reads all bytes of all texts.

Defined results: ``und`` with score 0 for a text that is NULL or has no letter. With no
labelled document every text is ``und``. Rows are predicted by themselves, so ties, repeated
rows and NULL ids need no rule; rows with a NULL language or id are not learned from. An
empty table gives an empty result. Other columns may have any name.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluiceway.llm.frames import col, text_bytes, text_groups

SEGMENT = 128
HIDDEN = 8
DOCUMENTS_PER_LANGUAGE = 400
SEGMENTS_PER_DOCUMENT = 6
EPOCHS, BATCH, RATE = 6, 256, 0.02
#: Segments that go through the network at once.
TOGETHER = 2048
UNKNOWN = "und"

Network = dict[str, np.ndarray]


def _fold() -> np.ndarray:
    table = np.arange(256, dtype=np.uint8)
    table[0x41:0x5B] += 32
    return table


def new_network(languages: int, seed: int = 6) -> Network:
    """For each direction the input table, recurrent weights and their bias; the output."""
    draw = np.random.default_rng(seed)
    made = {"out": draw.normal(0, 0.3, (languages, 2 * HIDDEN)), "bias": np.zeros((languages, 1))}
    for side in "fb":
        made["x" + side] = draw.normal(0, 0.3, (3 * HIDDEN, 256))
        made["h" + side] = draw.normal(0, 1 / np.sqrt(HIDDEN), (3 * HIDDEN, HIDDEN))
        made["c" + side] = np.zeros((HIDDEN, 1))
    return {name: value.astype(np.float32) for name, value in made.items()}


def _sigmoid(x: np.ndarray) -> np.ndarray:
    x *= np.float32(0.5)
    np.tanh(x, out=x)
    x *= np.float32(0.5)
    x += np.float32(0.5)
    return x


def _step(net: Network, side: str, byte: np.ndarray, h: np.ndarray):
    """Gates, candidate, its recurrent part, and the next state. Columns are segments."""
    given = net["x" + side].take(byte, axis=1)
    recurrent = net["h" + side] @ h
    gates = given[: 2 * HIDDEN]
    gates += recurrent[: 2 * HIDDEN]
    gates = _sigmoid(gates)
    inner = recurrent[2 * HIDDEN :]
    inner += net["c" + side]
    new = given[2 * HIDDEN :]
    new += gates[:HIDDEN] * inner
    np.tanh(new, out=new)
    keep = gates[HIDDEN:]
    state = new + keep * (h - new)
    return gates, new, inner, state


def _softmax(logits: np.ndarray) -> np.ndarray:
    logits -= logits.max(0)
    np.exp(logits, out=logits)
    logits /= logits.sum(0)
    return logits


def segment_probabilities(net: Network, x: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Sums over the positions of each segment; ``x`` is positions by segments."""
    steps, count = x.shape
    languages = len(net["bias"])
    forward = np.empty((steps, languages, count), np.float32)
    h = np.zeros((HIDDEN, count), np.float32)
    for t in range(steps):
        h = _step(net, "f", x[t], h)[3]
        np.matmul(net["out"][:, :HIDDEN], h, out=forward[t])
    h = np.zeros((HIDDEN, count), np.float32)
    total = np.zeros((languages, count), np.float32)
    shortest = length.min()
    for t in range(steps - 1, -1, -1):
        h = _step(net, "b", x[t], h)[3]
        there = None
        if t >= shortest:  # segments that end before this position have not begun yet
            there = (t < length).astype(np.float32)
            h *= there
        logits = forward[t]
        logits += net["out"][:, HIDDEN:] @ h
        logits += net["bias"]
        probabilities = _softmax(logits)
        total += probabilities if there is None else probabilities * there
    return total


def gradients(net: Network, x: np.ndarray, length: np.ndarray, label: np.ndarray):
    """Loss for each position and its gradients, by backpropagation through time."""
    steps, count = x.shape
    there = (np.arange(steps)[:, None] < length).astype(np.float32)
    states, tapes = {}, {}
    for side, order in (("f", range(steps)), ("b", range(steps - 1, -1, -1))):
        h = np.zeros((HIDDEN, count), np.float32)
        states[side], tapes[side] = np.empty((steps, HIDDEN, count), np.float32), {}
        for t in order:
            gates, new, inner, state = _step(net, side, x[t], h)
            tapes[side][t] = gates, new, inner, h
            h = state * there[t]
            states[side][t] = h
    both = np.concatenate((states["f"], states["b"]), 1)
    p = np.stack([_softmax(net["out"] @ s + net["bias"]) for s in both])
    places = there.sum()
    hit = np.take_along_axis(p, np.broadcast_to(label, (steps, 1, count)), 1)[:, 0]
    loss = -(np.log(hit + 1e-12) * there).sum() / places
    np.put_along_axis(
        p,
        np.broadcast_to(label, (steps, 1, count)),
        np.take_along_axis(p, np.broadcast_to(label, (steps, 1, count)), 1) - 1,
        1,
    )
    error = p * (there / places)[:, None, :]
    slope = {
        "out": np.einsum("tcn,thn->ch", error, both),
        "bias": error.sum((0, 2))[:, None],
    }
    back = np.einsum("ch,tcn->thn", net["out"], error)
    for side, order in (("f", range(steps - 1, -1, -1)), ("b", range(steps))):
        part = slice(0, HIDDEN) if side == "f" else slice(HIDDEN, None)
        w = net["h" + side]
        dw, dc = np.zeros_like(w), np.zeros_like(net["c" + side])
        dx = np.zeros((256, 3 * HIDDEN), np.float32)
        carried = np.zeros((HIDDEN, count), np.float32)
        for t in order:
            gates, new, inner, h = tapes[side][t]
            reset, keep = gates[:HIDDEN], gates[HIDDEN:]
            d = (back[t, part] + carried) * there[t]
            dnew = d * (1 - keep) * (1 - new * new)
            dkeep = d * (h - new) * keep * (1 - keep)
            dreset = dnew * inner * reset * (1 - reset)
            dinner = dnew * reset
            dgates = np.concatenate((dreset, dkeep))
            drecurrent = np.concatenate((dgates, dinner))
            dw += drecurrent @ h.T
            dc += dinner.sum(1, keepdims=True)
            np.add.at(dx, x[t], np.concatenate((dgates, dnew)).T)
            carried = w.T @ drecurrent + d * keep
        slope |= {"h" + side: dw, "c" + side: dc, "x" + side: dx.T}
    return float(loss), slope


def train_network(segments: list[bytes], labels: list[int], languages: int, epochs: int = EPOCHS) -> Network:
    """Adam over shuffled batches; the same input gives the same network."""
    net = new_network(languages)
    draw = np.random.default_rng(7)
    x = np.zeros((SEGMENT, len(segments)), np.uint8)
    length = np.array([len(s) for s in segments])
    for i, segment in enumerate(segments):
        x[: len(segment), i] = np.frombuffer(segment, np.uint8)
    x = _fold()[x]
    label = np.array(labels)
    first = {k: np.zeros_like(v) for k, v in net.items()}
    second = {k: np.zeros_like(v) for k, v in net.items()}
    batches = max(1, len(segments) // BATCH)
    step, steps = 0, epochs * batches
    for _ in range(epochs):
        for some in np.array_split(draw.permutation(len(segments)), batches):
            step += 1
            _, slope = gradients(net, x[:, some], length[some], label[some])
            norm = np.sqrt(sum(float((g * g).sum()) for g in slope.values()))
            clip = min(1.0, 1.0 / (norm + 1e-9))
            rate = RATE * (1 - (step - 1) / steps)
            for k, g in slope.items():
                g = g * clip
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.99 * second[k] + 0.01 * g * g
                m, v = first[k] / (1 - 0.9**step), second[k] / (1 - 0.99**step)
                net[k] = (net[k] - rate * m / (np.sqrt(v) + 1e-8)).astype(np.float32)
    return net


def text_probabilities(net: Network, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Mean probabilities of each text, 0 for empty ones; texts by languages."""
    sizes = np.diff(offsets)
    pieces = -(-sizes // SEGMENT)
    owner = np.repeat(np.arange(len(sizes)), pieces)
    nth = np.arange(len(owner)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    start = offsets[owner] + nth * SEGMENT
    length = np.minimum(SEGMENT, offsets[owner + 1] - start)
    order = np.argsort(-length, kind="stable")  # whole segments together
    sums = np.zeros((len(net["bias"]), len(owner)), np.float32)
    fold = _fold()
    for at in range(0, len(order), TOGETHER):
        some = order[at : at + TOGETHER]
        places = start[some] + np.arange(length[some].max())[:, None]
        x = fold[data[np.minimum(places, len(data) - 1)]]
        sums[:, some] = segment_probabilities(net, x, length[some])
    pooled = np.stack([np.bincount(owner, s, len(sizes)) for s in sums], 1)
    return pooled / np.maximum(sizes, 1)[:, None]


def _spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Some segments of each text, evenly over its length."""
    for batch in batches:
        langs, pieces = [], []
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
            raw = text.encode()
            count = -(-len(raw) // SEGMENT)
            for k in sorted({i * count // SEGMENTS_PER_DOCUMENT for i in range(SEGMENTS_PER_DOCUMENT)}):
                piece = raw[k * SEGMENT : (k + 1) * SEGMENT]
                if piece:
                    langs.append(lang)
                    pieces.append(piece)
        yield pa.RecordBatch.from_arrays(
            [pa.array(langs, pa.string()), pa.array(pieces, pa.binary())], ["lang", "piece"]
        )


def fit_language_id(
    documents: DataFrame,
    learn: Column | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
) -> tuple[list[str], Network | None]:
    """Languages and network; ``learn`` is a condition on the ``id`` of a document."""
    rows = documents.select(
        col(id_col).cast("bigint").alias("id"),
        col(lang_col).cast("string").alias("lang"),
        col(text_col).cast("string").alias("text"),
    ).where("lang IS NOT NULL AND id IS NOT NULL AND text IS NOT NULL")
    rows = rows.where(F.lit(True) if learn is None else learn)
    counts = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}
    languages = sorted(counts)
    if not languages:
        return [], None
    place = F.pmod(F.xxhash64("id", F.lit(6)), F.lit(1 << 30)) / float(1 << 30)
    chosen = F.lit(False)
    for lang, count in counts.items():
        chosen = chosen | ((F.col("lang") == lang) & (place < DOCUMENTS_PER_LANGUAGE / count))
    sample = rows.where(chosen).select("lang", "text").mapInArrow(_spread, "lang string, piece binary")
    # In an order of their own, so that the network does not depend on the partitions.
    pieces = sorted((r["lang"], bytes(r["piece"])) for r in sample.collect())
    if not pieces:
        return [], None
    labels = [languages.index(lang) for lang, _ in pieces]
    return languages, train_network([piece for _, piece in pieces], labels, len(languages))


def predict_language(
    documents: DataFrame,
    languages: list[str],
    net: Network | None,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``doc_id, lang_pred, score`` of every row."""
    shared = documents.sparkSession.sparkContext.broadcast((languages, net))

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        languages, net = shared.value
        for batch in batches:
            for at, texts in text_groups(batch.column("text")):
                rows = batch.slice(at, len(texts))
                letters = rows.column("letters").to_numpy(zero_copy_only=False)
                best, score = np.zeros(len(texts), int), np.zeros(len(texts))
                if languages:
                    p = text_probabilities(net, *text_bytes(texts))
                    best, score = p.argmax(1), np.clip(p.max(1).astype(float), 0, 1)
                known = letters & bool(languages)
                names = [languages[b] if k else UNKNOWN for b, k in zip(best, known)]
                yield pa.RecordBatch.from_arrays(
                    [
                        rows.column("doc_id"),
                        pa.array(names, pa.string()),
                        pa.array(np.where(known, score, 0.0)),
                    ],
                    ["doc_id", "lang_pred", "score"],
                )

    text = F.coalesce(col(text_col).cast("string"), F.lit(""))
    rows = documents.select(
        col(id_col).alias("doc_id"),
        text.alias("text"),
        F.rlike(text, F.lit(r"\p{L}")).alias("letters"),
    )
    schema = T.StructType([rows.schema["doc_id"]]).add("lang_pred", "string").add("score", "double")
    return rows.mapInArrow(predict, schema)


def language_report(documents: DataFrame, learn: Column | None = None, **options) -> DataFrame:
    """Learn from the documents with a language, and predict all: ``doc_id, lang_pred, score``."""
    languages, net = fit_language_id(documents, learn, **options)
    options.pop("lang_col", None)
    return predict_language(documents, languages, net, **options)
