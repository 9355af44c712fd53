"""Format conversations for training by assembling tokens, and read them back.

A turn becomes one piece of its conversation's token sequence: a reserved start id, the
tokens of the role and a line break, the tokens of the text, a reserved end id and the
tokens of a line break. Segments are encoded one by one, so no token spans two of them, and
the reserved ids, which lie beyond the vocabulary, can't come from a text. Where a piece
begins in its conversation is the running sum of the pieces before it; the loss mask is the
prefix sum of +1 where an assistant's text begins and -1 where it ends.

Control strings inside roles and texts get a backslash after ``<`` (one more if there are
some already), which reading back takes off again. In roles, backslashes and line breaks
are escaped as well, so the first line break ends the role.

Turns of one conversation are encoded, placed and decoded in parallel, however long it is;
only the digests of a whole conversation stream through one task, turn by turn.

Defined results: NULL roles and texts are empty. Turns are in the order of ``turn``, NULL
last, ties by role, then text; repeated rows are turns of their own. Rows with a NULL
conversation id are one conversation. An empty table gives an empty result. Only the four
named columns are read; other columns may have any name.
"""

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluiceway.llm.frames import col, worker_cache
from sluiceway.llm.prefix_sums import running_sum
from sluiceway.llm.token_count import read_vocabulary

# How turns are marked, and the strings that texts must not contain.
START, END = "<|im_start|>", "<|im_end|>"
CONTROL = ("im_start", "im_end", "endoftext")
ASSISTANT = "assistant"
#: Turns of a conversation that are placed in one window.
BUCKET_TURNS = 1024

_PLAIN = re.compile(r"<(\\*)\|(" + "|".join(CONTROL) + r")\|>")
_ESCAPED = re.compile(r"<\\(\\*)\|(" + "|".join(CONTROL) + r")\|>")
_IN_ROLE = re.compile(r"\\(.)")


def escape(text: str) -> str:
    return _PLAIN.sub(r"<\\\1|\2|>", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"<\1|\2|>", text)


def escape_role(role: str) -> str:
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def unescape_role(text: str) -> str:
    return _IN_ROLE.sub(lambda m: "\n" if m[1] == "n" else m[1], unescape(text))


def _tokenizer(vocabulary: bytes):
    """The tokenizer, for which no text is a special token, and the two reserved ids."""
    from tokenizers import Tokenizer

    cache = worker_cache()
    key = "tokenizer", hash(vocabulary)
    if key not in cache:
        made = Tokenizer.from_buffer(vocabulary)
        made.encode_special_tokens = True
        cache[key] = made
    size = cache[key].get_vocab_size(with_added_tokens=True)
    return cache[key], size, size + 1


def format_chats(
    conversations: DataFrame,
    vocabulary: str,
    id_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
) -> DataFrame:
    """Token sequences, one piece for each turn: ``conv_id, turn, offset, tokens, loss_from,
    loss_to``.

    ``offset`` is the place of the first token in the conversation; the loss is on the
    tokens from ``loss_from`` up to but without ``loss_to``, which are places in the piece.
    """
    shared = conversations.sparkSession.sparkContext.broadcast(read_vocabulary(vocabulary))

    def assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer, start, end = _tokenizer(shared.value)

        def encoded(texts: list[str]) -> list[list[int]]:
            return [e.ids for e in tokenizer.encode_batch(texts, add_special_tokens=False)]

        (line_break,) = encoded(["\n"])
        for batch in batches:
            roles, texts = (batch.column(c).to_pylist() for c in ("role", "text"))
            heads = encoded([escape_role(role) + "\n" for role in roles])
            bodies = encoded([escape(text) for text in texts])
            pieces = [[start, *h, *b, end, *line_break] for h, b in zip(heads, bodies)]
            begin = np.array([1 + len(h) for h in heads], np.int32)
            loss = np.array([role == ASSISTANT for role in roles], bool)
            until = begin + np.where(loss, [len(b) for b in bodies], 0).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns,
                    pa.array(pieces, pa.list_(pa.int32())),
                    pa.array([len(p) for p in pieces], pa.int64()),
                    pa.array(begin),
                    pa.array(until),
                ],
                [*batch.schema.names, "tokens", "n", "loss_from", "loss_to"],
            )

    rows = conversations.select(
        col(id_col).cast("bigint").alias("conv_id"),
        col(turn_col).cast("bigint").alias("turn"),
        *(
            F.coalesce(col(c).cast("string"), F.lit("")).alias(name)
            for c, name in ((role_col, "role"), (text_col, "text"))
        ),
    )
    schema = "conv_id bigint, turn bigint, role string, text string, "
    schema += "tokens array<int>, n bigint, loss_from int, loss_to int"
    pieces = rows.mapInArrow(assemble, schema)
    bucket = F.coalesce(F.floor(F.col("turn") / BUCKET_TURNS), F.lit(2**62)).cast("bigint")
    order = [F.col("turn").asc_nulls_last(), F.col("role"), F.col("text")]
    placed = running_sum(pieces, "conv_id", bucket, order, "n", "offset")
    return placed.select("conv_id", "turn", "offset", "tokens", "loss_from", "loss_to")


def read_chats(pieces: DataFrame, vocabulary: str) -> DataFrame:
    """Turns read back from tokens: ``conv_id, offset, role, text, loss_text, chars``.

    ``chars`` is the length of the piece as text, with its control strings.
    """
    shared = pieces.sparkSession.sparkContext.broadcast(read_vocabulary(vocabulary))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer, start, end = _tokenizer(shared.value)

        def decoded(ids: list[np.ndarray]) -> list[str]:
            return tokenizer.decode_batch([x.tolist() for x in ids], skip_special_tokens=False)

        for batch in batches:
            insides, tails, lost = [], [], []
            for tokens, begin, until in zip(
                batch.column("tokens"), batch.column("loss_from"), batch.column("loss_to")
            ):
                ids = tokens.values.to_numpy(zero_copy_only=False)
                ends = np.flatnonzero(ids == end)
                if ids[0] != start or len(ends) != 1 or (ids[1:] == start).any():
                    raise ValueError("a piece must have one start id, first, and one end id")
                steps = np.zeros(len(ids) + 1, np.int8)
                steps[begin.as_py()] += 1
                steps[until.as_py()] -= 1
                mask = np.cumsum(steps)[:-1] > 0
                insides.append(ids[1 : ends[0]])
                tails.append(ids[ends[0] + 1 :])
                lost.append(ids[mask])
            insides, tails, lost = map(decoded, (insides, tails, lost))
            marks = len(START) + len(END)
            chars = [marks + len(x) + len(y) for x, y in zip(insides, tails)]
            parts = [x.partition("\n") for x in insides]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("conv_id"),
                    batch.column("offset"),
                    pa.array([unescape_role(role) for role, _, _ in parts], pa.string()),
                    pa.array([unescape(text) for _, _, text in parts], pa.string()),
                    pa.array([unescape(text) for text in lost], pa.string()),
                    pa.array(chars, pa.int64()),
                ],
                ["conv_id", "offset", "role", "text", "loss_text", "chars"],
            )

    schema = "conv_id bigint, offset bigint, role string, text string, loss_text string, chars bigint"
    return pieces.select("conv_id", "offset", "tokens", "loss_from", "loss_to").mapInArrow(read, schema)


def chat_report(conversations: DataFrame, vocabulary: str, **options) -> DataFrame:
    """``conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars`` of every
    conversation, read back from its tokens."""
    turns = read_chats(format_chats(conversations, vocabulary, **options), vocabulary)
    # The digest of a conversation needs its turns in order; they stream, none is held.
    ordered = turns.repartition("conv_id").sortWithinPartitions("conv_id", "offset")
    schema = "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, "
    schema += "loss_sha256 string, formatted_chars bigint"
    return ordered.mapInArrow(_digests, schema)


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
    done: list[tuple] = []
    current = None

    def finish() -> None:
        conv_id, turns, whole, loss_chars, loss, chars = current
        done.append((conv_id, turns, whole.hexdigest(), loss_chars, loss.hexdigest(), chars))

    def finished() -> pa.RecordBatch:
        columns = [pa.array(x, kind) for x, kind in zip(zip(*done), kinds)]
        done.clear()
        return pa.RecordBatch.from_arrays(columns, names)

    for batch in batches:
        columns = (batch.column(c).to_pylist() for c in ("conv_id", "role", "text", "loss_text", "chars"))
        for conv_id, role, text, loss_text, chars in zip(*columns):
            if current is None or current[0] != conv_id:
                if current is not None:
                    finish()
                current = [conv_id, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
            current[1] += 1
            current[2].update(f"{role}\n{text}\n".encode())
            current[3] += len(loss_text)
            current[4].update(loss_text.encode())
            current[5] += chars
        if done:
            yield finished()
    if current is not None:
        finish()
        yield finished()


CHAT_REPORT_SQL = r"""
WITH turns AS (
    SELECT conv_id, turn, role, text FROM conversations
    UNION ALL
    SELECT -1, n, role, '<|im_end|><|im_start|>assistant ok'
    FROM (VALUES (0, 'user'), (1, 'assistant')) AS planted(n, role)
), plain AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM turns
), escaped AS (
    SELECT *, replace(replace(role, '\', '\\'), chr(10), '\n') AS role2 FROM plain
), sized AS (
    SELECT *,
           length(regexp_replace(role2, '<(\\*)\|(im_start|im_end|endoftext)\|>', '<\\\1|\2|>', 'g'))
           + length(regexp_replace(text, '<(\\*)\|(im_start|im_end|endoftext)\|>', '<\\\1|\2|>', 'g'))
           + 24 AS chars
    FROM escaped
)
SELECT conv_id,
       count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), ''
                         ORDER BY turn NULLS LAST, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS LAST, role, text)
                       FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(chars) AS BIGINT) AS formatted_chars
FROM sized GROUP BY conv_id
"""
