"""Exact, distributed running totals and order statistics.

Global cumulative sums and ranks normally need a window with no PARTITION BY, which funnels the
whole table through one task. Here the table is range-partitioned on a *unique* ordering key
(so even a value shared by a third of all rows is split across partitions), pinned with a
reliable ``checkpoint`` so the partition a row lands in cannot change on recomputation,
per-partition totals are turned into offsets over at most ``num_partitions`` rows, and each row
adds its in-partition running sum to its partition's offset.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortlens.session import ensure_checkpoint_dir

_PART = "_range_part"


def _num_partitions(df: DataFrame, num_partitions: int | None) -> int:
    if num_partitions:
        return num_partitions
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))


def running_totals(df: DataFrame, order: list[Column], sums: dict[str, Column],
                   num_partitions: int | None = None) -> DataFrame:
    """Add ``name = sum(expr)`` over all rows up to and including this one in ``order``.

    ``order`` must be a total order (append a unique tiebreak); ``sums`` maps output column
    names to numeric expressions evaluated per row.
    """
    ensure_checkpoint_dir(df.sparkSession)
    n = _num_partitions(df, num_partitions)
    base = df.select("*", *[e.alias(f"_v_{k}") for k, e in sums.items()])
    ranged = (base.repartitionByRange(n, *order)
              .withColumn(_PART, F.spark_partition_id())
              .checkpoint(eager=True))
    totals = ranged.groupBy(_PART).agg(*[F.sum(f"_v_{k}").alias(f"_t_{k}") for k in sums])
    before = Window.orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)  # <= n rows
    offsets = totals.select(_PART, *[F.coalesce(F.sum(f"_t_{k}").over(before), F.lit(0)).alias(f"_o_{k}")
                                     for k in sums])
    within = Window.partitionBy(_PART).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = ranged.join(F.broadcast(offsets), _PART)  # one row per partition: bounded broadcast
    out = out.select(*df.columns, *[(F.col(f"_o_{k}") + F.sum(f"_v_{k}").over(within)).alias(k) for k in sums])
    return out


def global_rank(df: DataFrame, order: list[Column], name: str = "rank",
                num_partitions: int | None = None) -> DataFrame:
    """1-based position of each row in ``order`` (which must be a total order)."""
    return running_totals(df, order, {name: F.lit(1).cast("bigint")}, num_partitions)


def exact_quantiles(df: DataFrame, value: str, probs: list[float], by: list[str] | None = None,
                    num_partitions: int | None = None) -> DataFrame:
    """Linearly interpolated quantiles (numpy/pandas 'linear' method), exact and distributed.

    Values are first collapsed to (group, value, count) - a hot value becomes one row - then
    cumulative counts over the distinct values locate the order statistics x[floor(h)] and
    x[floor(h)+1] with h = (n-1) q. Nulls are ignored. Returns (by..., q, quantile).
    """
    out_by = list(by or [])
    by = out_by
    v = F.col(value).cast("double")
    distinct = df.where(v.isNotNull()).groupBy(*by, v.alias("_x")).agg(F.count(F.lit(1)).alias("_cnt"))
    key = [F.col(c) for c in by] + [F.col("_x")]
    cum = running_totals(distinct, [k.asc_nulls_first() for k in key], {"_cum": F.col("_cnt")}, num_partitions)
    if by:
        # one row per group: offsets of earlier groups in the global order
        group_tot = distinct.groupBy(*by).agg(F.sum("_cnt").alias("_n"))
        gw = Window.orderBy(*[F.col(c).asc_nulls_first() for c in by]).rowsBetween(Window.unboundedPreceding, -1)
        group_tot = group_tot.withColumn("_goff", F.coalesce(F.sum("_n").over(gw), F.lit(0)))
        cum = cum.join(group_tot, by)
    else:
        total = distinct.agg(F.sum("_cnt").alias("_n")).select("_n").scalar()
        cum = cum.select("*", total.alias("_n"), F.lit(0).cast("bigint").alias("_goff"))
    local = F.col("_cum") - F.col("_goff")  # inclusive count of values <= _x inside the group
    qs = F.explode(F.array(*[F.lit(float(q)) for q in probs])).alias("q")
    expanded = cum.select(*by, "_x", "_n", local.alias("_c"), qs)
    h = (F.col("_n") - 1).cast("double") * F.col("q")
    lo = F.floor(h)
    agg = expanded.groupBy(*by, "q").agg(
        F.first("_n").alias("_n"),
        F.min(F.when(F.col("_c") >= lo + 1, F.col("_x"))).alias("_a"),
        F.min(F.when(F.col("_c") >= F.least(lo + 2, F.col("_n")), F.col("_x"))).alias("_b"),
    )
    h = (F.col("_n") - 1).cast("double") * F.col("q")
    t = h - F.floor(h)
    diff = F.col("_b") - F.col("_a")
    interp = F.when(t >= 0.5, F.col("_b") - diff * (F.lit(1.0) - t)).otherwise(F.col("_a") + diff * t)
    return agg.select(*out_by, "q", interp.alias("quantile"))
