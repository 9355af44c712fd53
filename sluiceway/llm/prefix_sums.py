"""Running sums within groups of any size, as two levels of bounded windows."""

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sluiceway.llm.frames import fresh


def running_sum(
    rows: DataFrame, group: str, bucket: Column, order: list[Column], value: str, name: str
) -> DataFrame:
    """Add ``name``: the sum of ``value`` over the earlier rows of the group, without this one.

    ``bucket`` cuts the order of a group into ranges (no row of a bucket comes before one of
    a lower bucket), so that no window holds more than a bucket's rows or a group's buckets.
    Sums of whole buckets are partial sums, made before the shuffle.
    """
    at, base = fresh(rows, "_bucket"), fresh(rows, "_base")
    rows = rows.withColumn(at, bucket)
    earlier = (W.unboundedPreceding, -1)
    totals = rows.groupBy(F.col(group).alias("_g"), F.col(at).alias("_b")).agg(
        F.sum(value).alias("_sum")
    )
    within_group = W.partitionBy("_g").orderBy("_b").rowsBetween(*earlier)
    totals = totals.select(
        "_g", "_b", F.coalesce(F.sum("_sum").over(within_group), F.lit(0)).alias(base)
    )
    same = [F.col(group).eqNullSafe(F.col("_g")), F.col(at).eqNullSafe(F.col("_b"))]
    both = rows.join(totals, reduce(Column.__and__, same)).drop("_g", "_b")
    within_bucket = W.partitionBy(group, at).orderBy(*order).rowsBetween(*earlier)
    own = F.coalesce(F.sum(value).over(within_bucket), F.lit(0))
    return both.withColumn(name, F.col(base) + own).drop(at, base)
