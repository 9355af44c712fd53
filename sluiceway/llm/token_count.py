"""Token counts by byte-pair merging, without making token ids.

A piece of text starts as one symbol per byte. A linked list holds the symbols and a heap
the adjacent pairs that may merge, by rank and then by place; the lowest is popped and
merged until no pair is left. Tokens are the initial symbols minus the merges.

The vocabulary is a byte-level BPE file for the ``tokenizers`` library. It is read on the
driver, must not be larger than ``MAX_VOCABULARY_BYTES`` and travels with the tasks, so
executors need no copy of the file.

Defined results: NULL counts as the empty text, which has no tokens. Added tokens of the
file inside a text are one token each, as in the library's default. Rows are independent,
so ties, repeated rows and NULL ids need no rule; all columns but the two named ones are
ignored; an empty table gives an empty result.
"""

import json
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluiceway.llm.frames import col, text_groups, worker_cache

MAX_VOCABULARY_BYTES = 64 << 20
#: Counts of so many pieces are remembered by a worker, then of the latest ones only.
REMEMBERED_PIECES = 400_000

# How byte-level BPE cuts a text before merging.
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

COUNTS = "doc_id bigint, n_bytes bigint, n_tokens bigint, n_merges bigint"


class Merges:
    """The merge table of a vocabulary, and counting with it."""

    def __init__(self, vocabulary: bytes):
        content = json.loads(vocabulary)
        model = content["model"]
        ids = {_to_bytes(token): number for token, number in model["vocab"].items()}
        self.symbols = [ids.get(bytes([byte]), len(ids) + byte) for byte in range(256)]
        #: A pair of symbols, the left one shifted, to its rank; and what each rank makes.
        self.ranks: dict[int, int] = {}
        self.made: list[int] = []
        for rank, merge in enumerate(model["merges"]):
            left, right = merge if isinstance(merge, list) else merge.split(" ")
            left, right = _to_bytes(left), _to_bytes(right)
            self.ranks[ids[left] << 32 | ids[right]] = rank
            self.made.append(ids[left + right])
        added = sorted((t["content"] for t in content["added_tokens"]), key=len, reverse=True)
        self.added = regex.compile("|".join(map(regex.escape, added))) if added else None
        self.pieces = regex.compile(PIECES)
        self.counts = _Counts(self)

    def count(self, text: str) -> tuple[int, int]:
        """Tokens, and merges that led to them."""
        if self.added is None:
            return self._plain(text)
        parts = self.added.split(text)
        tokens = len(parts) - 1
        merges = 0
        for part in parts:
            own, done = self._plain(part)
            tokens += own
            merges += done
        return tokens, merges

    def _plain(self, text: str) -> tuple[int, int]:
        tokens = sum(map(self.counts.__getitem__, self.pieces.findall(text)))
        return tokens, len(text.encode()) - tokens

    def merged(self, piece: str) -> int:
        """Tokens of one piece."""
        symbols = list(map(self.symbols.__getitem__, piece.encode()))
        end = count = len(symbols)
        rank_of, made = self.ranks.get, self.made
        heap = []
        for at in range(end - 1):
            rank = rank_of(symbols[at] << 32 | symbols[at + 1])
            if rank is not None:
                heap.append(rank << 32 | at)
        if not heap:
            return count
        heapify(heap)
        after = list(range(1, end + 1))
        before = list(range(-1, end - 1))
        while heap:
            lowest = heappop(heap)
            at, rank = lowest & 0xFFFFFFFF, lowest >> 32
            right = after[at]
            # Stale if the pair here has merged meanwhile: a merged symbol is marked by -1.
            if right >= end or rank_of(symbols[at] << 32 | symbols[right]) != rank:
                continue
            symbols[at] = symbol = made[rank]
            symbols[right] = -1
            count -= 1
            after[at] = right = after[right]
            if right < end:
                before[right] = at
                rank = rank_of(symbol << 32 | symbols[right])
                if rank is not None:
                    heappush(heap, rank << 32 | at)
            left = before[at]
            if left >= 0:
                rank = rank_of(symbols[left] << 32 | symbol)
                if rank is not None:
                    heappush(heap, rank << 32 | left)
        return count


class _Counts(dict):
    """Remembered counts of pieces; the older half goes when there are too many."""

    def __init__(self, merges: Merges):
        self.merges = merges

    def __missing__(self, piece: str) -> int:
        count = self.merges.merged(piece)
        if len(piece) <= 64:
            if len(self) >= REMEMBERED_PIECES:
                for old in list(self)[: REMEMBERED_PIECES // 2]:
                    del self[old]
            self[piece] = count
        return count


def _to_bytes(token: str) -> bytes:
    """Byte-level vocabularies write every byte as one printable character: printable
    Latin-1 bytes as themselves, the others in order from U+0100 on."""
    cache = worker_cache()
    if "bytes" not in cache:
        plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
        table = {chr(byte): byte for byte in plain}
        others = [byte for byte in range(256) if byte not in set(plain)]
        table |= {chr(0x100 + i): byte for i, byte in enumerate(others)}
        cache["bytes"] = table
    return bytes(cache["bytes"][c] for c in token)


def read_vocabulary(path: str) -> bytes:
    with open(path, "rb") as file:
        content = file.read(MAX_VOCABULARY_BYTES + 1)
    if len(content) > MAX_VOCABULARY_BYTES:
        raise ValueError(f"{path} is no vocabulary: it has more than {MAX_VOCABULARY_BYTES} bytes")
    return content


def count_tokens(
    documents: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, n_merges`` of every text; ``vocabulary`` is a file's path."""
    shared = documents.sparkSession.sparkContext.broadcast(read_vocabulary(vocabulary))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = worker_cache()
        key = "merges", hash(shared.value)
        if key not in cache:
            cache[key] = Merges(shared.value)
        merges = cache[key]
        for batch in batches:
            for at, texts in text_groups(batch.column("text")):
                counts = [merges.count(text.as_py()) for text in texts]
                tokens, merged = np.array(counts, np.int64).reshape(-1, 2).T
                rows = batch.slice(at, len(texts))
                yield pa.RecordBatch.from_arrays(
                    [rows.column("id"), rows.column("n"), pa.array(tokens), pa.array(merged)],
                    ["doc_id", "n_bytes", "n_tokens", "n_merges"],
                )

    text = F.coalesce(col(text_col).cast("string"), F.lit(""))
    rows = documents.select(
        col(id_col).cast("bigint").alias("id"),
        F.octet_length(text).cast("bigint").alias("n"),
        text.alias("text"),
    )
    return rows.mapInArrow(count, COUNTS)
