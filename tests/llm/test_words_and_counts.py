import random

import pytest
from tokenizers import Tokenizer

from sluiceway.llm.queries import QUERIES, VOCABULARY
from sluiceway.llm.token_count import Merges, count_tokens, read_vocabulary
from tests.llm.conftest import SF_DIR, collected


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(VOCABULARY)
    return lambda text: len(tokenizer.encode(text, add_special_tokens=False).ids)


def test_counts_equal_the_library(library):
    merges = Merges(read_vocabulary(VOCABULARY))
    draw = random.Random(1)
    letters = "ab tthe in12 \n\t'sé😀 日本İ\x00"
    for k in range(3000):
        text = "".join(draw.choice(letters) for _ in range(draw.randrange(30)))
        if k % 3 == 0:
            text = text.replace("a", "<|endoftext|>")
        assert merges.count(text)[0] == library(text), text
    for text in ("", " ", "a" * 100_000, "ab" * 50_000, "<|endoftext|>" * 3, "<|endoftext"):
        assert merges.count(text)[0] == library(text)


def test_forgetting_pieces_changes_nothing(library, monkeypatch):
    monkeypatch.setattr("sluiceway.llm.token_count.REMEMBERED_PIECES", 4)
    merges = Merges(read_vocabulary(VOCABULARY))
    text = "one two three four five six seven eight nine ten one two three"
    assert merges.count(text)[0] == library(text)
    assert len(merges.counts) <= 4


def test_edge_rows(spark, texts, clash, library):
    rows = [(1, None), (2, ""), (3, "é" * 40_000), (3, "é" * 40_000), (None, "Hello  World\n")]
    found = collected(count_tokens(clash(texts(rows)), VOCABULARY))
    expected = [(i, len((t or "").encode()), library(t or "")) for i, t in rows]
    assert [r[:3] for r in found] == sorted(expected, key=repr)
    assert all(b - n == m or "<|" in "" for _, b, n, m in found)
    assert collected(count_tokens(texts([]), VOCABULARY)) == []


def test_query(spark, given, library):
    found = {r["doc_id"]: r for r in QUERIES["op1_token_count"](spark, SF_DIR).collect()}
    for row in given("documents").collect():
        one = found.pop(row["doc_id"])
        assert one["n_tokens"] == library(row["text"])
        assert one["n_bytes"] == len(row["text"].encode())
        assert one["over_limit"] == (one["n_tokens"] > 512)
    assert not found


def test_a_vocabulary_is_bounded(tmp_path, monkeypatch):
    monkeypatch.setattr("sluiceway.llm.token_count.MAX_VOCABULARY_BYTES", 10)
    with pytest.raises(ValueError):
        read_vocabulary(VOCABULARY)
