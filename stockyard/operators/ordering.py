"""Global row numbers and running sums without a single-task window.

A window without PARTITION BY sends the table to one task.  Here rows are range-partitioned
on the complete ordering (so equal leading values may still be split), written once, and each
range learns how many rows, or how much weight, lies in the ranges before it.  The table of
ranges has one row per shuffle partition, whatever the size of the data.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from stockyard.workspace import materialize

_POSITION_MASK = (1 << 33) - 1
# rows of a chunk of consecutive positions; a group's figures are looked up per chunk, so no group is a hot key
_CHUNK_BITS = 20


def join_groups(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Join on group columns; null is a group like any other."""
    names = {k: f"_grp_{i}" for i, k in enumerate(keys)}
    right = right.withColumnsRenamed(names)
    return left.join(right, reduce(Column.__and__, [F.col(f"`{k}`").eqNullSafe(F.col(n)) for k, n in names.items()]),
                     how).drop(*names.values())


def number_rows(df: DataFrame, order: list[str | Column], name: str = "row_no",
                total: str | None = None) -> DataFrame:
    """0-based position of every row under ``order``, which must be a total order."""
    placed = (df.repartitionByRange(*order).sortWithinPartitions(*order)
              .withColumn("_ord_slot", F.monotonically_increasing_id()))
    stored = (materialize(placed, "numbered", "zstd")
              .withColumn("_ord_range", F.shiftright("_ord_slot", 33))
              .withColumn("_ord_at", F.col("_ord_slot").bitwiseAND(F.lit(_POSITION_MASK)))
              .drop("_ord_slot"))
    sizes = stored.groupBy("_ord_range").agg((F.max("_ord_at") + 1).alias("_ord_rows"))
    everything = W.orderBy("_ord_range").rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    starts = sizes.select(
        "_ord_range",
        F.coalesce(F.sum("_ord_rows").over(W.orderBy("_ord_range").rowsBetween(W.unboundedPreceding, -1)),
                   F.lit(0)).alias("_ord_start"),
        F.sum("_ord_rows").over(everything).alias("_ord_total"))
    # one row per range: bounded by the number of shuffle partitions
    out = stored.join(F.broadcast(starts), "_ord_range").withColumn(name, F.col("_ord_start") + F.col("_ord_at"))
    if total:
        out = out.withColumn(total, F.col("_ord_total"))
    return out.drop("_ord_range", "_ord_at", "_ord_start", "_ord_total")


def rank_within(df: DataFrame, groups: list[str], order: list[str], name: str = "rank",
                group_size: str | None = None) -> DataFrame:
    """0-based rank inside each group; a group of any size is spread over many tasks."""
    numbered = number_rows(df, [*groups, *order], "_ord_no").withColumn("_ord_chunk", F.shiftright("_ord_no", _CHUNK_BITS))
    whole = W.partitionBy(*groups)
    firsts = numbered.groupBy("_ord_chunk", *groups).agg(F.min("_ord_no").alias("_ord_low"), F.count(F.lit(1)).alias("_ord_n"))
    # windows over one row per (group, chunk)
    firsts = firsts.select("_ord_chunk", *groups, F.min("_ord_low").over(whole).alias("_ord_first"),
                           F.sum("_ord_n").over(whole).alias("_ord_size"))
    out = join_groups(numbered, firsts, ["_ord_chunk", *groups]).withColumn(name, F.col("_ord_no") - F.col("_ord_first"))
    if group_size:
        out = out.withColumn(group_size, F.col("_ord_size"))
    return out.drop("_ord_no", "_ord_chunk", "_ord_first", "_ord_size")


def running_sums(df: DataFrame, groups: list[str], order: list[str], sums: dict[str, str]) -> DataFrame:
    """Add inclusive running sums ``{output: input}`` per group along ``order``, and each group's
    total as ``{output}_total``.

    Give it pre-aggregated rows, one per (group, order) value: then no value is hot.
    """
    stored = materialize(df.repartitionByRange(*groups, *order).withColumn("_ord_range", F.spark_partition_id()),
                         "running")
    inside = W.partitionBy("_ord_range", *groups).orderBy(*order).rowsBetween(W.unboundedPreceding, 0)
    # windows over one row per (group, range)
    before = W.partitionBy(*groups).orderBy("_ord_range").rowsBetween(W.unboundedPreceding, -1)
    whole = W.partitionBy(*groups)
    tops = stored.groupBy(*groups, "_ord_range").agg(*[F.sum(c).alias(f"_ord_t_{o}") for o, c in sums.items()])
    starts = tops.select(*groups, "_ord_range", *[
        F.coalesce(F.sum(f"_ord_t_{o}").over(before), F.lit(0)).alias(f"_ord_s_{o}") for o in sums],
        *[F.sum(f"_ord_t_{o}").over(whole).alias(f"{o}_total") for o in sums])
    out = join_groups(stored.select("*", *[F.sum(c).over(inside).alias(f"_ord_i_{o}") for o, c in sums.items()]),
                      starts, [*groups, "_ord_range"])
    for o in sums:
        out = out.withColumn(o, F.col(f"_ord_i_{o}") + F.col(f"_ord_s_{o}"))
    return out.drop("_ord_range", *[f"_ord_{k}_{o}" for o in sums for k in "is"])


def to_long(df: DataFrame, columns: list[str], keep: list[str] = (), variable: str = "feature",
            value: str = "value") -> DataFrame:
    """One row per (row, column) with the columns as doubles."""
    slim = df.select(*keep, *[F.col(c).cast("double").alias(c) for c in columns])
    return slim.unpivot(list(keep), columns, variable, value)


def exact_quantiles(long: DataFrame, groups: list[str], value: str, probs: dict[str, float]) -> DataFrame:
    """Exact interpolated quantiles per group (at least one group column), nulls ignored.

    Equal values are counted before any shuffle; the value at a rank is the first whose running
    count passes it, so no task ever holds a whole column.
    """
    counts = (long.where(F.col(value).isNotNull()).groupBy(*groups, value)
              .agg(F.count(F.lit(1)).alias("_n")))
    ranked = running_sums(counts, groups, [value], {"_cum": "_n"})
    aggregates, outputs = [], []
    for name, p in probs.items():
        at = F.lit(float(p)) * (F.col("_cum_total") - 1)
        aggregates += [F.min(F.when(F.col("_cum") > F.floor(at), F.col(value))).alias(f"_lo_{name}"),
                       F.min(F.when(F.col("_cum") > F.ceil(at), F.col(value))).alias(f"_hi_{name}"),
                       F.max(at - F.floor(at)).alias(f"_f_{name}")]
        lo, hi = F.col(f"_lo_{name}"), F.col(f"_hi_{name}")
        outputs.append((lo + (hi - lo) * F.col(f"_f_{name}")).alias(name))
    return ranked.groupBy(*groups).agg(*aggregates).select(*groups, *outputs)
