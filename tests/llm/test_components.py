import random

from sluiceway.llm.components import connected_components
from sluiceway.llm.frames import Scratch
from tests.llm.brute import Union


def test_components(spark):
    draw = random.Random(3)
    edges = [(i, i + 1) for i in range(100, 160)]  # a path
    edges += [(1000, 1001 + i) for i in range(80)] + [(1005, 3)]  # a star
    edges += [(draw.randrange(200, 400), draw.randrange(200, 400)) for _ in range(90)]
    edges += [(7, 7), (-5, 2**40), (100, 101), (101, 100)]
    union = Union()
    for a, b in edges:
        union.join(a, b)
    frame = spark.createDataFrame(edges, "a bigint, b bigint").repartition(5)
    found = [tuple(r) for r in connected_components(frame, Scratch(spark), "c").collect()]
    assert len(found) == len({i for i, _ in found})
    nodes = {x for a, b in edges if a != b for x in (a, b)}
    assert dict(found) == {x: union.find(x) for x in nodes}


def test_no_edges(spark):
    empty = spark.createDataFrame([], "a bigint, b bigint")
    assert connected_components(empty, Scratch(spark), "c").collect() == []
