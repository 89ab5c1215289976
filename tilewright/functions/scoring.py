"""Scores and ranks."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

from tilewright.sources.scratch import written


def round_half_up(x: Column, digits: int = 1) -> Column:
    """Half-up rounding on the binary value."""
    return F.floor(x * 10**digits + 0.5) / 10**digits


def bounded_score(p90: Column) -> Column:
    """A share as a score from 0 to 100."""
    return round_half_up(F.least(F.greatest(p90, F.lit(0.0)), F.lit(1.0)) * 100)


def running_total(counts: DataFrame, key: str, n: str, out: str, ascending: bool = True, parts: int | None = None, by: tuple[str, ...] = ()) -> DataFrame:
    """``counts`` (one row per value of ``by`` and ``key``) with ``out``: the sum of ``n`` over all smaller values of the same
    ``by``, without a window over a whole ``by``.

    Rows are range-partitioned by ``by`` and the key and written with their range's number, so that every later step, also after a
    lost executor, sees the same ranges. They are summed by range and the ranges' sums added on top: no task sees more than its range.
    """
    order = F.col(key) if ascending else F.col(key).desc()
    dealt = written(counts.repartitionByRange(*[parts][: parts is not None], *by, order).withColumn("_part", F.spark_partition_id()), "ranges")
    inner = Window.partitionBy("_part", *by).orderBy(order)
    dealt = dealt.withColumn("_in", F.sum(n).over(inner.rowsBetween(Window.unboundedPreceding, -1)))
    sums = dealt.groupBy("_part", *by).agg(F.sum(n).alias("_sum"))
    # at most as many sums as ranges (``parts``, or the session's shuffle partitions) and values of ``by``
    a, b = sums.alias("a"), sums.alias("b")
    same = [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in by]
    before = a.join(b, reduce(and_, same, F.col("b._part") < F.col("a._part")), "left")
    before = before.groupBy("a._part", *(f"a.{c}" for c in by)).agg(F.coalesce(F.sum("b._sum"), F.lit(0)).alias("_before"))
    if not by:
        before = F.broadcast(before)
    rows = dealt.alias("d").join(before.alias("e"), reduce(and_, [F.col(f"d.{c}").eqNullSafe(F.col(f"e.{c}")) for c in by], F.col("d._part") == F.col("e._part")))
    return rows.select(*(f"d.{c}" for c in counts.columns), (F.coalesce("d._in", F.lit(0)) + F.col("e._before")).alias(out))


def percentile_rank(df: DataFrame, value: str, out: str = "rank") -> DataFrame:
    """``df`` with the mid-rank percentile of ``value``: 100 * (smaller + half of the equal) / all, rounded half up to 1 digit.

    Null values are no part of the population and get a null rank. Equal values are counted first, so ties, however many,
    cost one row. The only value of a population of one has rank 50.
    """
    counts = df.where(F.col(value).isNotNull()).groupBy(F.col(value).alias("_v")).agg(F.count("*").alias("_n"))
    ranked = running_total(counts, "_v", "_n", "_below")
    ranked = ranked.crossJoin(F.broadcast(ranked.agg(F.sum("_n").alias("_all"))))
    ranked = ranked.select("_v", round_half_up(100 * (F.col("_below") + 0.5 * F.col("_n")) / F.col("_all")).alias(out))
    return df.join(ranked, F.col(value) == F.col("_v"), "left").drop("_v")


def histogram(df: DataFrame, value: str, edges: list[float]) -> DataFrame:
    """(bin, low, high, n) for each bin of fixed edges, empty ones too; bins hold their low edge, the last one both."""
    spark = df.sparkSession
    bins = spark.createDataFrame([(i, float(a), float(b)) for i, (a, b) in enumerate(zip(edges[:-1], edges[1:], strict=True))], "bin int, low double, high double")
    v, last = F.col(value), len(edges) - 2
    at = F.when(v == edges[-1], last).otherwise(F.size(F.filter(F.array(*[F.lit(float(e)) for e in edges]), lambda e: e <= v)) - 1)
    counts = df.where(v.between(edges[0], edges[-1])).groupBy(at.cast("int").alias("bin")).agg(F.count("*").alias("n"))
    return bins.join(counts, "bin", "left").fillna(0, ["n"])
