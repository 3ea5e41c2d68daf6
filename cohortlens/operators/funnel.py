"""Ordered lifecycle funnel (FN1-FN4)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens import config
from cohortlens.functions.stats import safe_div
from cohortlens.operators.activity import first_occurrence


def user_step_flags(users: DataFrame, events: DataFrame, steps: list[str] | None = None,
                    group_by: str | None = None, source: str = "user_action") -> DataFrame:
    """One row per user with ``_pass_i`` flags for every step.

    Step 0 counts every user. Step i passes iff step i-1 passed and the *first* occurrence of
    step i is strictly later than the first occurrence of step i-1; missing timestamps fail.
    The chain starts from the first signup *event*, not ``users.signup_timestamp``.
    """
    steps = list(steps or config.FUNNEL_STEPS)
    first = first_occurrence(events, steps, source)
    cols = ["user_id"] + ([group_by] if group_by else [])
    joined = users.select(*cols).join(first, "user_id", "left")
    flags = [F.lit(True).alias("_pass_0")]
    prev = F.lit(True)
    for i in range(1, len(steps)):
        cur = prev & F.coalesce(F.col(f"_first_{i}") > F.col(f"_first_{i - 1}"), F.lit(False))
        flags.append(cur.alias(f"_pass_{i}"))
        prev = cur
    return joined.select(*cols, *flags)


def compute_funnel(users: DataFrame, events: DataFrame, group_by: str | None = None,
                   steps: list[str] | None = None, source: str = "user_action") -> DataFrame:
    """FN3/FN4: step, users, conversion_rate, drop_off_rate [, group_by].

    One aggregation counts every step at once; the per-step rows come from ``inline`` of an array
    of structs (no window, no second pass). Grouped output drops null groups.
    """
    steps = list(steps or config.FUNNEL_STEPS)
    return funnel_table(user_step_flags(users, events, steps, group_by, source), steps, group_by)


def funnel_table(flags: DataFrame, steps: list[str], group_by: str | None = None) -> DataFrame:
    """FN3/FN4 from the users' step flags."""
    keys = [group_by] if group_by else []
    if group_by:
        flags = flags.where(F.col(group_by).isNotNull())
    counts = flags.groupBy(*keys).agg(*[
        F.count_if(F.col(f"_pass_{i}")).alias(f"_n_{i}") for i in range(len(steps))
    ])
    rows = []
    for i, step in enumerate(steps):
        n_i, total = F.col(f"_n_{i}"), F.col("_n_0")
        prev = F.col(f"_n_{i - 1}") if i else n_i
        rows.append(F.struct(
            F.lit(i).alias("_step_order"),
            F.lit(step).alias("step"),
            n_i.alias("users"),
            safe_div(n_i, total).alias("conversion_rate"),
            (safe_div(prev - n_i, prev) if i else F.lit(0.0)).alias("drop_off_rate"),
        ))
    out = counts.select(*keys, F.inline(F.array(*rows)))
    return (out.orderBy(*keys, "_step_order")
            .select("step", "users", "conversion_rate", "drop_off_rate", *keys))
