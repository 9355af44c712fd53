import re

import numpy as np
import pyarrow as pa
import pytest

import sluiceway.llm.words as words
from sluiceway.llm.frames import text_bytes, text_groups
from tests.llm.brute import LOWER, shingle_set

TEXTS = ["", None, "A b", "  a  B", "x" * 3000, " " * 900 + "Éé z", "x y", *"qqqqq", "a\x0bb\x1cc d-e_f9"]
CLASSES = [
    (words.space_separated(), rb"[^\x20\x09-\x0D]+"),
    (words.letters_and_digits(), rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"),
]


@pytest.mark.parametrize("block", [1 << 18, 97, 8])
@pytest.mark.parametrize("member, pattern", CLASSES)
def test_words_are_those_of_the_pattern(monkeypatch, block, member, pattern):
    monkeypatch.setattr(words, "BLOCK", block)
    known = {}
    for _, group in text_groups(pa.array(TEXTS, pa.string()), 1000):
        found = words.words_of(*text_bytes(group), member)
        for i, text in enumerate(group.to_pylist()):
            expected = re.findall(pattern, text.translate(LOWER).encode())
            assert len(found.of(i)) == len(expected)
            for word, value in zip(expected, found.of(i).tolist()):
                assert known.setdefault(word, value) == value
    assert len(set(known.values())) == len(known)


@pytest.mark.parametrize("size", [1, 2, 5])
def test_shingle_sets(size):
    texts = [t or "" for t in TEXTS] + ["a b a b a b", "A b\tc d e F g"]
    (_, group), = text_groups(pa.array(texts, pa.string()))
    sets, first = words.shingles_of(words.words_of(*text_bytes(group), CLASSES[0][0]), size)
    assert np.diff(first).tolist() == [len(shingle_set(t, size)) for t in texts]
