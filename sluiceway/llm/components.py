"""Connected components of a graph that never leaves the executors."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluiceway.llm.frames import Scratch


def connected_components(edges: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """``id, component`` (its smallest id) of every node with an edge; ``edges`` has ``a, b``.

    Large-star and small-star steps alternate until no edge changes: every node comes to
    hang on the smallest node it can reach, in a number of rounds that grows with the
    logarithm of the longest path. A round aggregates edges by node with partial sums and
    joins the minimum back, so a node with very many edges is split like any skewed key.
    Each round is kept in the scratch folder. Loops are dropped; no edges, no rows.
    """
    edges = edges.where("a <> b")
    stars = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    stars = scratch.keep(stars, f"{name}-0")
    before, step = _fingerprint(stars), 0
    while before[0]:
        step += 1
        stars = scratch.keep(_small_star(_large_star(stars)), f"{name}-{step}")
        if step > 1:
            scratch.drop(f"{name}-{step - 1}")
        now = _fingerprint(stars)
        if now == before:
            break
        before = now
    leaves = stars.select(F.col("u").alias("id"), F.col("v").alias("component"))
    roots = stars.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
    return leaves.unionByName(roots)


def _fingerprint(stars: DataFrame) -> tuple:
    """Number and hash of the edges, to see whether a round changed any."""
    # The hash is folded to 31 bits so that its sum over any number of edges fits.
    hashed = F.xxhash64("u", "v").bitwiseAND(F.lit(0x7FFFFFFF))
    return tuple(stars.agg(F.count(F.lit(1)), F.sum(hashed.cast("decimal(30,0)"))).head())


def _large_star(stars: DataFrame) -> DataFrame:
    """Hang the larger neighbours of every node on its smallest neighbour (or itself)."""
    both = stars.union(stars.select("v", "u"))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    hung = both.where("v > u").join(least, "u")
    return hung.select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(stars: DataFrame) -> DataFrame:
    """Hang every node and its smaller neighbours on the smallest of them."""
    least = stars.groupBy("u").agg(F.min("v").alias("m"))
    moved = stars.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v"))).distinct()
