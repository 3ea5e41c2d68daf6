"""Order statistics by counting, without sorting a table.

:func:`keys_at_ranks` finds the rows at given ranks of an (instant, key) order inside one lazy plan: rows
are counted by day, which gives the day that holds each rank (a window over as many rows as the calendar
has days) and, in the same pass, pivots drawn by hash from each day's rows; rows of that day are counted
between its pivots, and only what lies between two of them is ordered. :func:`totals_up_to` gives every row its
running total in the same way. :func:`quantiles` narrows intervals
around many columns' order statistics at once, in a few aggregates over the rows as they are.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortlens.functions.scalars import with_scalars

PIVOTS = 1024
BEFORE_ALL = -(1 << 62)  # the second of a null instant
BEFORE_COUNTS = -(1 << 63)  # no count is below the smallest long
DAY = 86_400


def _up_to(order: str, *by: str):
    return Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)


def _below(pivots: Column, key: Column) -> Column:
    """How many of the sorted pivots are smaller than the key, by halving steps."""
    steps = F.array(*[F.lit(PIVOTS >> i) for i in range(PIVOTS.bit_length())])
    return F.aggregate(steps, F.lit(0), lambda at, step: F.when(
        (at + step <= F.size(pivots)) & (F.get(pivots, at + step - 1) < key), at + step).otherwise(at))


def keys_at_ranks(df: DataFrame, instant: str, key: str, ranks: Callable[[Column], list[Column]]) -> DataFrame:
    """One row: ``k0``, ``k1``, ... are the (instant, key) structs at the 1-based ranks that ``ranks``
    gives for the number of rows; null for a rank outside the table. Nulls order first, equal rows
    count singly.

    No group of rows is ordered whole: the day that holds a rank (or one instant in it, which a third of
    all rows may share) is cut into ``PIVOTS`` parts before one of them is."""
    day = F.coalesce(F.floor(F.col(instant).cast("timestamp").cast("long") / DAY), F.lit(BEFORE_ALL))
    rows = df.select(day.alias("_d"), F.struct(F.col(instant).alias("at"), F.col(key).alias("key")).alias("_k"))
    chance = F.xxhash64("_k")
    drawn = rows.groupBy("_d", F.pmod(chance, F.lit(PIVOTS)).alias("_draw")).agg(F.count(F.lit(1)).alias("_n"), F.min_by("_k", chance).alias("_p"))
    days = drawn.groupBy("_d").agg(F.sum("_n").alias("_n"), F.array_sort(F.collect_list("_p")).alias("_p"))  # PIVOTS a day at most
    days = days.select("_d", "_n", "_p", F.sum("_n").over(_up_to("_d")).alias("_end"), F.sum("_n").over(Window.partitionBy()).alias("_all"))
    wanted = F.array(*[F.struct(F.lit(j).alias("_j"), r.cast("long").alias("_rank")) for j, r in enumerate(ranks(F.col("_all")))])

    def holding(counted: DataFrame, *names: str) -> DataFrame:
        """The rows whose counts reach over the rank, and the rank among theirs."""
        here = (F.col("_rank") <= F.col("_end")) & (F.col("_rank") > F.col("_end") - F.col("_n"))
        return F.broadcast(counted.where(here).select("_j", *names, (F.col("_rank") - F.col("_end") + F.col("_n")).alias("_rank")))  # a row a rank

    of_day = holding(days.select("_d", "_n", "_p", "_end", F.inline(wanted)), "_d", "_p")
    parted = rows.join(of_day, "_d").select("_j", "_rank", "_k", _below(F.col("_p"), F.col("_k")).alias("_part"))
    parts = parted.groupBy("_j", "_rank", "_part").agg(F.count(F.lit(1)).alias("_n")).withColumn("_end", F.sum("_n").over(_up_to("_part", "_j")))
    last = parted.drop("_rank").join(holding(parts, "_part"), ["_j", "_part"])
    place = F.row_number().over(Window.partitionBy("_j").orderBy("_k"))
    found = last.withColumn("_place", place).where(F.col("_place") == F.col("_rank"))
    return found.agg(*[F.max(F.when(F.col("_j") == j, F.col("_k"))).alias(f"k{j}") for j in range(len(ranks(F.lit(0))))])


def totals_up_to(df: DataFrame, key: Column, sums: dict[str, str], by: list[str] | None = None) -> DataFrame:
    """``df`` with, for each entry of ``sums`` (name: column of counts), the total over the rows of the same
    group up to this one in ascending order of ``key`` (unique in a group, nulls first) and, as
    ``all_<name>``, over the whole group.

    One lazy plan without a sort of the table: pivots drawn by hash cut each group into ``PIVOTS`` + 1 parts,
    whose totals are counted; only the rows of one part are ordered together. The three readings of ``df`` ask
    for the same columns, so that Spark computes an aggregated ``df`` once and reuses its exchange."""
    by = list(by or [])
    # a null group is left out by the joins below; said here, all readings of ``df`` are the same plan
    rows = reduce(lambda d, c: d.where(F.col(c).isNotNull()), by, df).withColumn("_k", key)
    chance = F.xxhash64("_k")
    totals = [F.sum(c).alias(f"_t_{k}") for k, c in sums.items()]
    drawn = rows.groupBy(*by, F.pmod(chance, F.lit(PIVOTS)).alias("_draw")).agg(F.min_by("_k", chance).alias("_p"), *totals)
    # a group's pivots: PIVOTS at most
    groups = drawn.groupBy(*by).agg(F.array_sort(F.collect_list("_p")).alias("_pivots"), *[F.sum(f"_t_{k}").alias(f"all_{k}") for k in sums])
    if by:
        rows = rows.join(groups, by)
    else:
        rows = with_scalars(rows, groups)
    whole = [f"all_{k}" for k in sums]
    for c in whole if by else []:  # true of every row; without it the reading for the offsets, which needs no whole total, were another plan
        rows = rows.where(F.col(c).isNull() | (F.col(c) >= F.lit(BEFORE_COUNTS)))
    parted = rows.select(*df.columns, "_k", *whole, _below(F.col("_pivots"), F.col("_k")).alias("_part"))
    before = Window.partitionBy(*by).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # a row a part
    parts = parted.groupBy(*by, "_part").agg(*totals)
    offsets = parts.select(*by, "_part", *[F.coalesce(F.sum(f"_t_{k}").over(before), F.lit(0)).alias(f"_o_{k}") for k in sums])
    within = _up_to("_k", *by, "_part")
    here = parted.join(offsets if by else F.broadcast(offsets), [*by, "_part"])
    return here.select(*df.columns, *[(F.col(f"_o_{k}") + F.sum(c).over(within)).alias(k) for k, c in sums.items()], *whole)


def _around(value: Column, share: float, accuracy: int) -> Column:
    """Three of a column's values, in order, near the share of its rows."""
    off = 2.0 / accuracy
    return F.percentile_approx(value, [min(1.0, max(0.0, share + d)) for d in (-off, 0.0, off)], accuracy)


@dataclass
class _Open:
    """A column whose order statistic at ``rank`` (0-based) lies strictly between two values."""

    rank: int
    share: float
    rows: int
    low: float = -math.inf
    high: float = math.inf
    below: int = 0  # rows up to low

    def narrowed(self, v: Column) -> Column:
        above = F.lit(True) if self.low == -math.inf else v > self.low
        return F.when(above & (F.lit(True) if self.high == math.inf else v < self.high), v)


def quantiles(df: DataFrame, columns: list[str], prob: float = 0.5, accuracy: int = 10_000) -> dict[str, float | None]:
    """The linearly interpolated quantile of each column over its values that are neither null nor NaN
    (None where there is none), exact.

    Every pass is one aggregate over the wide rows: a sketch of each open column proposes three of its
    values near the rank, the next pass counts the rows below and up to them and finds the value that
    follows each; a column is done when the counts reach its two order statistics, else only the rows
    between two proposed values stay open, some ten-thousandths of them."""
    if not columns:
        return {}
    value = {c: F.nanvl(F.col(f"`{c}`").cast("double"), F.lit(None).cast("double")) for c in columns}
    first = df.agg(*[F.count(value[c]).alias(f"n{i}") for i, c in enumerate(columns)],
                   *[_around(value[c], prob, accuracy).alias(f"p{i}") for i, c in enumerate(columns)]).first()
    out: dict[str, float | None] = dict.fromkeys(columns)
    todo, proposed = {}, {}
    for i, c in enumerate(columns):
        if first[f"n{i}"]:
            h = (first[f"n{i}"] - 1) * prob
            todo[c], proposed[c] = _Open(math.floor(h), h - math.floor(h), first[f"n{i}"]), sorted(set(first[f"p{i}"]))
    while todo:
        tried = [(c, p) for c in todo for p in proposed[c]]
        counted = df.agg(*[F.struct(F.count_if(value[c] < p).alias("less"), F.count_if(value[c] <= p).alias("upto"),
                                    F.min(F.when(value[c] > p, value[c])).alias("after")).alias(f"x{i}") for i, (c, p) in enumerate(tried)]).first()
        for (c, p), x in zip(tried, counted):
            at = todo.get(c)
            if at is None:
                continue
            if x["less"] <= at.rank < x["upto"]:
                out[c] = interpolated(p, p if at.rank + 1 < x["upto"] or x["after"] is None else x["after"], at.share)
                del todo[c]
            elif x["upto"] <= at.rank and p > at.low:
                at.low, at.below = p, x["upto"]
            elif x["less"] > at.rank and p < at.high:
                at.high, at.rows = p, x["less"]
        if todo:
            sketch = df.agg(*[_around(at.narrowed(value[c]), (at.rank - at.below + 0.5) / (at.rows - at.below), accuracy).alias(f"p{i}")
                              for i, (c, at) in enumerate(todo.items())]).first()
            proposed = {c: sorted(set(p)) for c, p in zip(todo, sketch)}
    return out


def interpolated(a: float, b: float, share: float) -> float:
    """Between two neighbours, from the nearer one (as the usual libraries do)."""
    return b - (b - a) * (1.0 - share) if share >= 0.5 else a + (b - a) * share
