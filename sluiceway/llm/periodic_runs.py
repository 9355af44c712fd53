"""Find periodic runs of words: stretches that repeat themselves at once.

A run is a stretch of consecutive words with smallest period q and a length of at least
``max(min_length, 2 * q)`` that no neighbouring word extends keeping the period.

Words become numbers, and a suffix automaton of the sequence is built. The states on the way
from a prefix's state to the root are the suffixes of that prefix, and each has the place
where it last ended as its colour. Appending a word recolours the whole way. The way consists
of segments of one colour each, kept as the preferred paths of a link-cut tree (splay trees in
order of depth), so that access takes one step for each segment, amortised a logarithmic
number. If a segment's longest suffix, of length L, ended last d words before, and d <= L, it
is a repetition with period d of L + d words, a square at least. d is its smallest period: a
smaller one would have made the suffix end later. Squares are extended to runs, each once.

A run of at least ``min_length`` words has some ``min_length // 2`` consecutive words again
further on. So only stretches all of whose words lie in such repeated word sequences go
through the automaton, and stretches are cut again until that holds within each of them.
That loses no run: a run lies within one stretch. Most texts have no such stretch.

Each text is handled by itself, so there is no shuffle, and a hot source or a frequent text
changes nothing. Memory is about 150 bytes a word of a stretch.

Defined results: NULL and texts without words have no runs. Very long texts are handled
whole. Rows are independent, so ties, repeated rows and NULL ids need no rule; an empty table
gives an empty result. Only the two named columns are read; others may have any name.
"""

from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluiceway.llm.frames import col, map_columns, text_bytes, text_groups
from sluiceway.llm.words import mix, space_separated, words_of

RUN = "struct<start:bigint,length:bigint,period:bigint>"
# What cuts words, as a pattern of the words.
WORD = r"[^\x20\x09-\x0D]+"


class SuffixAutomaton:
    """States of a sequence of numbers from 0: their longest length, suffix link, and the state
    of every prefix. A state's first transition is in arrays, further ones are in a dict."""

    def __init__(self, codes: list[int]):
        self.length, self.link = array("q", [0]), array("q", [-1])
        self.word, self.to = array("q", [-1]), array("q", [-1])
        self.more: dict[int, dict[int, int]] = {}
        self.prefix = array("q")
        length, link, word, to, more = self.length, self.link, self.word, self.to, self.more
        last = 0
        for code in codes:
            new = len(length)
            length.append(length[last] + 1)
            link.append(0)
            word.append(-1)
            to.append(-1)
            at = last
            last = new
            self.prefix.append(new)
            while at >= 0:
                if word[at] == code:
                    old = to[at]
                    break
                if word[at] < 0:
                    word[at], to[at] = code, new
                else:
                    others = more.get(at)
                    if others is None:
                        more[at] = {code: new}
                    elif code in others:
                        old = others[code]
                        break
                    else:
                        others[code] = new
                at = link[at]
            if at >= 0:
                if length[old] == length[at] + 1:
                    link[new] = old
                else:
                    link[new] = self._split(at, code, old)

    def _split(self, at: int, code: int, old: int) -> int:
        """A state for the shorter suffixes of ``old``, which now end in more places."""
        length, link, word, to, more = self.length, self.link, self.word, self.to, self.more
        clone = len(length)
        length.append(length[at] + 1)
        link.append(link[old])
        word.append(word[old])
        to.append(to[old])
        if old in more:
            more[clone] = dict(more[old])
        link[old] = clone
        while at >= 0:
            if word[at] == code:
                if to[at] != old:
                    break
                to[at] = clone
            else:
                if more[at][code] != old:
                    break
                more[at][code] = clone
            at = link[at]
        return clone


class LastEnds:
    """Where the suffixes in each state ended last: colours of paths in a link-cut tree.

    Each splay tree holds one preferred path in order of depth; its root has the colour.
    """

    def __init__(self, automaton: SuffixAutomaton):
        states = len(automaton.length)
        self.length = automaton.length
        self.above = array("q", automaton.link)  # parent in the splay tree, or of the path
        self.left, self.right = array("q", [-1]) * states, array("q", [-1]) * states
        self.colour = array("q", [-1]) * states

    def append(self, state: int, end: int) -> list[tuple[int, int]]:
        """Colour the way from the state to the root with ``end``. Returns colour and longest
        length of each segment of the way before, as far as it had ended within its length."""
        above, right, colour, length = self.above, self.right, self.colour, self.length
        squares = []
        lower, at = -1, state
        while at >= 0:
            last = self._splay(at)
            if last >= 0 and end - last <= length[at]:
                squares.append((last, length[at]))
            below = right[at]
            if below >= 0:
                colour[below] = last
            right[at] = lower
            lower, at = at, above[at]
        colour[lower] = end
        if lower != state:
            self._splay(state)
            colour[state] = end
        return squares

    def _splay(self, x: int) -> int:
        """Make ``x`` the root of its splay tree; returns the tree's colour."""
        above, left, right = self.above, self.left, self.right
        top = x
        parent = above[top]
        while parent >= 0 and (left[parent] == top or right[parent] == top):
            top, parent = parent, above[parent]
        last = self.colour[top]
        while x != top:
            parent = above[x]
            if parent == top:
                self._rotate(x)
                break
            grand = above[parent]
            reached = grand == top
            self._rotate(parent if (left[parent] == x) == (left[grand] == parent) else x)
            self._rotate(x)
            if reached:
                break
        self.colour[x] = last
        return last

    def _rotate(self, x: int) -> None:
        above, left, right = self.above, self.left, self.right
        parent = above[x]
        grand = above[parent]
        if left[parent] == x:
            inner = right[x]
            left[parent], right[x] = inner, parent
        else:
            inner = left[x]
            right[parent], left[x] = inner, parent
        if inner >= 0:
            above[inner] = parent
        above[parent], above[x] = x, grand
        if grand >= 0:
            if left[grand] == parent:
                left[grand] = x
            elif right[grand] == parent:
                right[grand] = x


def runs_of(codes: np.ndarray, min_length: int) -> list[tuple[int, int, int]]:
    """``start, length, period`` of all runs of a sequence of numbers from 0."""
    automaton = SuffixAutomaton(codes.tolist())
    ends = LastEnds(automaton)
    known: dict[int, int] = {}  # period to the end of the last run that has it
    runs = []
    for end, state in enumerate(automaton.prefix):
        for last, suffix in ends.append(state, end):
            period = end - last
            if end < known.get(period, 0):
                continue
            start = _agreeing(codes, last - suffix, period, -1) + 1
            stop = _agreeing(codes, last + 1, period, 1) + period
            known[period] = stop
            if stop - start >= max(min_length, 2 * period):
                runs.append((start, stop - start, period))
    return runs


def _agreeing(codes: np.ndarray, at: int, period: int, step: int) -> int:
    """The first place from ``at`` on, in steps of 1 or -1, whose word differs from the one a
    period later; the end of the sequence counts as different."""
    size = 16
    while True:
        low, high = (at, at + size) if step > 0 else (at - size + 1, at + 1)
        low, high = max(low, 0), min(high, len(codes) - period)
        if low >= high:
            return at
        differs = np.flatnonzero(codes[low:high] != codes[low + period : high + period])
        if len(differs):
            return low + int(differs[0 if step > 0 else -1])
        at = high if step > 0 else low - 1
        size *= 2


def _repeated(hashes: np.ndarray, first: np.ndarray, size: int) -> np.ndarray:
    """Which words lie in a sequence of ``size`` words that its text has more than once."""
    covered = np.zeros(len(hashes), bool)
    count = len(hashes) - size + 1
    if count < 2:
        return covered
    keys = hashes[:count].copy()
    for k in range(1, size):
        keys *= np.uint64(0x9FB21C651E98DF25)
        keys += hashes[k : count + k] ^ np.uint64(k)
    text = np.repeat(np.arange(len(first) - 1), np.diff(first))[:count]
    keys = mix(keys + text.astype(np.uint64) * np.uint64(0xD1342543DE82EF95))
    inside = np.flatnonzero(np.arange(count) + size <= first[text + 1])
    order = inside[np.argsort(keys[inside], kind="stable")]
    same = keys[order[1:]] == keys[order[:-1]]
    again = np.zeros(len(order), bool)
    again[1:] |= same
    again[:-1] |= same
    edges = np.zeros(len(hashes) + 1, np.int32)
    edges[order[again]] += 1
    np.subtract.at(edges, order[again] + size, 1)
    return np.cumsum(edges[:-1]) > 0


def _stretches(covered: np.ndarray) -> Iterator[tuple[int, int]]:
    turns = np.flatnonzero(np.diff(covered.astype(np.int8), prepend=0, append=0))
    yield from zip(turns[0::2].tolist(), turns[1::2].tolist())


def _runs_within(words: list[bytes], low: int, high: int, min_length: int) -> list[tuple[int, int, int]]:
    """The runs among the words from ``low`` to ``high``."""
    numbers: dict[bytes, int] = {}
    codes = np.array([numbers.setdefault(w, len(numbers)) for w in words[low:high]], np.int64)
    runs, open_ = [], [(0, len(codes))]
    while open_:
        a, b = open_.pop()
        if b - a < min_length:
            continue
        part = mix(codes[a:b].astype(np.uint64) + np.uint64(1))
        covered = _repeated(part, np.array([0, b - a]), max(min_length // 2, 1))
        if covered.all():
            runs += [(low + a + s, n, q) for s, n, q in runs_of(codes[a:b], min_length)]
        else:
            open_ += [(a + s, a + e) for s, e in _stretches(covered)]
    return runs


def _collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words without those in a run after its first period."""
    if not runs:
        return b" ".join(words)
    keep = np.ones(len(words), bool)
    for start, length, period in runs:
        keep[start + period : start + length] = False
    return b" ".join(words[i] for i in np.flatnonzero(keep).tolist())


def find_runs(
    documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_length: int = 12
) -> DataFrame:
    """``doc_id, n_words, runs, collapsed`` of every row: the runs by start, then period, and the
    text without the repetitions, its words joined by one space."""
    if min_length < 2:
        raise ValueError("a run has two words at least")
    schema = f"doc_id bigint, n_words bigint, runs array<{RUN}>, collapsed string"
    member = space_separated()

    def find(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for at, texts in text_groups(batch.column("text")):
            data, offsets = text_bytes(texts)
            found = words_of(data, offsets, member)
            covered = _repeated(found.hashes, found.first, max(min_length // 2, 1))
            counts, runs, collapsed = [], [], []
            for i, (low, high) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist())):
                # Splits at the same bytes that separate words above.
                words = data[low:high].tobytes().split()
                own = covered[found.first[i] : found.first[i + 1]]
                some = []
                for a, b in _stretches(own):
                    some += _runs_within(words, a, b, min_length)
                some.sort(key=lambda run: (run[0], run[2]))
                counts.append(len(words))
                runs.append([dict(zip(("start", "length", "period"), run)) for run in some])
                collapsed.append(_collapsed(words, some))
            ids = batch.column("id")[at : at + len(texts)]
            texts_out = pa.array(collapsed, pa.large_binary()).view(pa.large_string()).cast(pa.string())
            run = pa.struct([(n, pa.int64()) for n in ("start", "length", "period")])
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(counts, pa.int64()), pa.array(runs, pa.list_(run)), texts_out],
                ["doc_id", "n_words", "runs", "collapsed"],
            )

    rows = documents.select(
        col(id_col).cast("bigint").alias("id"),
        F.coalesce(col(text_col).cast("string"), F.lit("")).alias("text"),
    )
    return map_columns(rows, find, schema)


def planted_text(doc_id: Column, text: Column) -> Column:
    """The text, in a tenth of all documents with words from some place on repeated.

    With h the crc32 of the id, n the number of words and g = floor(h / 10): if h % 10 = 0, every
    word i >= a becomes word a + (i - a) % p, where a = g % n, p = 1 + floor((n - a) / (3 + g % 8)).
    """
    h = F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary"))
    text = F.coalesce(text.cast("string"), F.lit(""))

    def repeated(words: Column) -> Column:
        n, g = F.size(words).cast("bigint"), F.floor(h / 10)
        a = g % n
        p = 1 + F.floor((n - a) / (3 + g % 8))
        place = lambda i: F.when(i < a, i).otherwise(a + (i - a) % p).cast("int")
        new = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.get(words, place(i)))
        return F.when(n == 0, text).otherwise(F.array_join(new, " "))

    # Over an array of one, so that the words are made once and not for every place.
    words = F.array(F.regexp_extract_all(text, F.lit(WORD), F.lit(0)))
    return F.when(h % 10 == 0, F.element_at(F.transform(words, repeated), 1)).otherwise(text)


def run_report(documents: DataFrame, **options) -> DataFrame:
    """``doc_id, n_runs``, the longest run (ties: smallest start, then period; NULL if none) and
    the digests of all runs and of the collapsed text."""
    found = find_runs(documents, **options)
    best = F.array_max(
        F.transform(
            "runs",
            lambda r: F.struct(
                r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period")
            ),
        )
    )
    line = lambda r: F.concat(
        r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","),
        r["period"].cast("string"), F.lit("\n"),
    )
    listed = F.array_join(F.transform("runs", line), "")
    found = found.withColumn("_best", best)
    length, period = F.col("_best.length"), -F.col("_best.period")
    return found.select(
        "doc_id",
        F.size("runs").cast("bigint").alias("n_runs"),
        (-F.col("_best.start")).alias("start"),
        length.alias("length"),
        period.alias("period"),
        F.floor(1000 * length / period).cast("bigint").alias("exponent_milli"),
        F.sha2(listed.cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )
