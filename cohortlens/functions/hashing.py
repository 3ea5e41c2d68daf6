"""Deterministic hash bucketing (AS1) as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

BUCKETS = 1_000_000


def md5_bucket(*parts, modulus: int = BUCKETS) -> Column:
    """(int(md5(':'.join(parts)), 16) mod modulus) computed exactly in BIGINT arithmetic.

    The 128-bit digest is folded as four 32-bit hex chunks with Horner's rule modulo ``modulus``,
    so the result equals the big-integer remainder without leaving the JVM.
    """
    digest = F.md5(F.concat_ws(":", *[p.cast("string") if isinstance(p, Column) else F.lit(str(p)) for p in parts]))
    shift = F.lit((1 << 32) % modulus).cast("bigint")
    acc = F.lit(0).cast("bigint")
    for i in range(4):
        chunk = F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("bigint")
        acc = F.pmod(acc * shift + chunk, F.lit(modulus).cast("bigint"))
    return acc


def cumulative_allocations(variants: list[tuple[str, float]]) -> list[tuple[str, float]]:
    """Running allocation sums accumulated in float order, exactly as a sequential loop would."""
    out, cum = [], 0.0
    for name, alloc in variants:
        cum += alloc
        out.append((name, cum))
    return out


def pick_variant(bucket: Column, variants: list[tuple[str, float]], modulus: int = BUCKETS) -> Column:
    """First variant whose cumulative allocation exceeds bucket / modulus, else the last one."""
    normalized = bucket.cast("double") / float(modulus)
    expr = None
    for name, cum in cumulative_allocations(variants):
        cond = normalized < F.lit(cum)
        expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
    return expr.otherwise(F.lit(variants[-1][0]))
