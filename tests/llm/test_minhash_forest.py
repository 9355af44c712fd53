import random

import pytest

import sluiceway.llm.minhash_forest as forest
from sluiceway.llm.queries import QUERIES
from tests.llm.brute import near_duplicates
from tests.llm.conftest import SF_DIR, collected


def near_copies(seed, copies, words, changes, first_id=0):
    draw = random.Random(seed)
    base = [f"w{draw.randrange(10**6)}" for _ in range(words)]
    rows = []
    for k in range(copies):
        own = list(base)
        for _ in range(draw.randrange(changes + 1)):
            own[draw.randrange(words)] = f"v{draw.randrange(10**6)}"
        rows.append((first_id + k, " ".join(own)))
    return rows


@pytest.mark.parametrize("sf_dir", [SF_DIR, "/root/testdata/sf0.01"])
def test_query_finds_all_components(spark, sf_dir):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    assert collected(QUERIES["op2_minhash_forest"](spark, sf_dir)) == near_duplicates(rows, 2)


def test_single_links_at_the_threshold_in_groups_of_hundreds(texts):
    """300 pairs of one template, each linked by exactly 0.80 and with no other text.

    The template has 40 words and each pair 51 of its own, so a text has 90 shingles. The second
    text of a pair has five words changed: 80 shingles of 100 are common to both.
    """
    draw = random.Random(9)
    rows = []
    for pair in range(300):
        words = [f"t{i}" for i in range(40)] + [f"p{pair}.{i}" for i in range(51)]
        rows.append((2 * pair, " ".join(words)))
        for place in draw.sample(range(41, 89, 2), 5):
            words[place] = f"c{pair}.{place}"
        rows.append((2 * pair + 1, " ".join(words)))
    expected = near_duplicates(rows, 2)
    assert sum(not r[3] for r in expected) == 300
    assert collected(forest.minhash_components(texts(rows), shingle=2)) == expected


def test_crowded_regions_lose_no_link(texts):
    # Far more near copies than a sparse region holds, about half of their pairs linked, and
    # some texts that are linked with few others.
    rows = near_copies(1, 150, 80, 9) + near_copies(2, 60, 80, 14, 1000) + near_copies(3, 40, 12, 1, 2000)
    rows += [(3000 + i, "the very same words here") for i in range(50)]
    found = collected(forest.minhash_components(texts(rows), shingle=2))
    assert found == near_duplicates(rows, 2)


def test_blocks_across_components(texts, monkeypatch):
    monkeypatch.setattr(forest, "BLOCK_SHINGLES", 400)
    monkeypatch.setattr(forest, "SPARSE", 3)
    monkeypatch.setattr(forest, "WINDOW", 1)
    rows = near_copies(4, 120, 60, 8)
    assert collected(forest.minhash_components(texts(rows), shingle=2)) == near_duplicates(rows, 2)


def test_blocks_of_short_texts_are_bounded(texts, monkeypatch):
    # Far less shingles than a block holds, but a square of all texts would be large.
    packer = forest._packer

    def bounded(shingle):
        pack = packer(shingle)

        def checked(rows):
            assert len(rows) <= 3000
            return pack(rows)

        return checked

    monkeypatch.setattr(forest, "_packer", bounded)
    rows = [(i, f"one two three four v{i} six seven eight nine ten") for i in range(5000)]
    rows += [(10_000 + i, rows[i][1] + " more") for i in range(0, 5000, 100)]
    found = {r["doc_id"]: r["component_id"] for r in forest.minhash_components(texts(rows), shingle=2).collect()}
    assert found == {i: i % 10_000 for i, _ in rows}


@pytest.mark.parametrize("size", [2, 5])
def test_edge_rows(texts, clash, size):
    long = " ".join(f"l{i}" for i in range(60_000))
    rows = [
        (1, None), (2, ""), (3, " \t\n"), (4, "one"), (5, "ONE "), (6, "one two"), (7, "two one"),
        (8, long), (9, long + " end"), (10, "a b c d e"), (10, "a b c d e"), (None, "a b c d e"),
        (None, None), (12, "é É"), (13, "é é"),
    ]
    found = collected(forest.minhash_components(clash(texts(rows)), shingle=size))
    assert found == near_duplicates(rows, size)


def test_exactly_the_threshold(texts):
    nine = [f"x{i}" for i in range(9)]
    rows = [(1, " ".join([*nine, "p"])), (2, " ".join([*nine, "q"])), (3, " ".join(nine[:8] + ["r", "s"]))]
    # 8 of 10 shingles: 80 percent. 7 of 11: less.
    assert [r[2] for r in near_duplicates(rows, 2)] == [1, 1, 3]
    assert collected(forest.minhash_components(texts(rows), shingle=2)) == near_duplicates(rows, 2)


def test_empty_table(texts):
    assert collected(forest.minhash_components(texts([]))) == []


def test_drop_keeps_one_of_each_group(texts, clash):
    rows = near_copies(5, 6, 100, 1) + [(100, None), (101, ""), (None, "x y"), (102, "other words in here")]
    frame = clash(texts(rows))
    kept = forest.drop_near_duplicates(frame)
    assert kept.columns == frame.columns
    assert {r["doc_id"] for r in kept.collect()} == {0, 100, 101, 102, None}
