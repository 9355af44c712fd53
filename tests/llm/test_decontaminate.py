import random
import time

import numpy as np
import pyarrow as pa
import pytest

import sluiceway.llm.decontaminate as decontaminate
from sluiceway.llm.frames import text_bytes
from sluiceway.llm.queries import QUERIES
from sluiceway.llm.words import letters_and_digits, lower_ascii, words_of
from tests.llm.brute import contamination
from tests.llm.conftest import SF_DIR, collected

DOCS = [
    (1, "a b c D"), (2, None), (3, ""), (4, "x a b! y é É"), (4, "x a b! y é É"), (None, "a b"),
    (5, "q " * 50), (6, "q " * 12), (7, "--- ... "), (8, "z " * 40_000 + "a b"), (9, "ab"), (10, "A-B/c"),
]
ITEMS = [
    (1, "A  b"), (None, "x"), (2, "c"), (3, None), (4, ""), (5, "é"), (1, "q " * 20), (7, "q " * 13),
    (8, "..."), (9, "q " * 30),
]


@pytest.fixture
def items(spark):
    def make(rows):
        return spark.createDataFrame(rows, "item_id bigint, text string")

    return make


@pytest.mark.parametrize("sf_dir", [SF_DIR, "/root/testdata/sf0.01"])
def test_query(spark, sf_dir):
    tables = (("documents", "doc_id"), ("benchmark", "item_id"))
    docs, items = (
        [(r[key], r["text"]) for r in spark.read.parquet(f"{sf_dir}/{name}.parquet").collect()] for name, key in tables
    )
    assert collected(QUERIES["op5_decontaminate"](spark, sf_dir)) == contamination(docs, items)


@pytest.mark.parametrize("chunk", [32 << 20, 60])
def test_edge_rows(texts, items, clash, monkeypatch, chunk):
    monkeypatch.setattr(decontaminate, "CHUNK_BYTES", chunk)
    found = decontaminate.contamination_report(clash(texts(DOCS)), clash(items(ITEMS)))
    assert collected(found) == contamination(DOCS, ITEMS)


def test_long_windows_shift_past_texts(texts, items):
    passage = " ".join(f"p{i}" for i in range(30))
    docs = [(k, " ".join(f"n{i}" for i in range(k)) + " " + passage) for k in range(40)]
    docs += [(100, " ".join(passage.split()[:12])), (101, " ".join(passage.split()[4:17]))]
    rows = [(1, passage), (2, " ".join(passage.split()[10:25]))]
    assert collected(decontaminate.contamination_report(texts(docs), items(rows))) == contamination(docs, rows)


def test_empty_tables(texts, items):
    assert collected(decontaminate.contamination_report(texts([]), items(ITEMS))) == []
    found = collected(decontaminate.contamination_report(texts(DOCS), items([])))
    assert found == contamination(DOCS, [])


def test_drop_keeps_clean_rows_whole(texts, items, clash):
    frame = clash(texts(DOCS))
    kept = decontaminate.drop_contaminated(frame, items(ITEMS))
    assert kept.schema.names == frame.schema.names
    clean = {(r[0], r[1]) for r in contamination(DOCS, ITEMS) if not r[5]}
    assert sorted((r["doc_id"] for r in kept.collect()), key=repr) == sorted((i for i, _ in clean), key=repr)


@pytest.mark.parametrize("window", [1, 2, 3, 5])
def test_random_texts_of_few_words(texts, items, monkeypatch, window):
    monkeypatch.setattr(decontaminate, "PAIRS_AT_ONCE", 7)
    draw = random.Random(window)
    some = lambda most: " ".join(draw.choice("abcd") for _ in range(draw.randrange(most)))
    docs = [(i, some(30)) for i in range(80)]
    rows = [(i % 9, some(9)) for i in range(12)]
    found = collected(decontaminate.contamination_report(texts(docs), items(rows), window=window))
    assert found == contamination(docs, rows, window)


def test_memory_near_the_bound():
    """Tables of a chunk take a few bytes for each byte of text and are made in seconds."""
    draw = np.random.default_rng(1)
    words = np.array([f"w{n:x}" for n in draw.integers(0, 1 << 20, 200_000)])
    rows, size = [], 0
    while size < decontaminate.CHUNK_BYTES - 4096:
        text = " ".join(draw.choice(words, 300))
        rows.append((f"item{len(rows)}", text))
        size += len(text)
    started = time.perf_counter()
    patterns = decontaminate.Patterns(rows, 13)
    assert time.perf_counter() - started < 60
    assert patterns.bytes() < 10 * size
    passages = pa.array([rows[5][1], "x " * 50 + rows[77][1][3:400], "y " * 100], pa.large_string())
    data, offsets = text_bytes(passages)
    found = words_of(data, offsets, letters_and_digits())
    _, _, item = patterns.find(lower_ascii()[data], found)
    assert {patterns.ids[i] for i in item.tolist()} == {"item5", "item77"}
