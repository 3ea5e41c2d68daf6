"""Chronological train / validation / test split (SP1-SP4).

The (signup, user_id) keys at the ends of train and validation are selected by refining counts
(:func:`keys_at_ranks`); every row is then compared with them. Rows are neither sorted nor shuffled,
nothing runs while the query is built, and a signup instant that a third of all users share is no
group of one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortlens import config
from cohortlens.functions.selection import keys_at_ranks

TRAIN, VALIDATION, TEST = "train", "validation", "test"


def _check_fractions(train_frac: float, val_frac: float) -> None:
    """Every part gets a share: train, validation and what they leave for test."""
    shares = {TRAIN: train_frac, VALIDATION: val_frac, TEST: 1.0 - train_frac - val_frac}
    empty = [name for name, share in shares.items() if not share > 1e-12]
    if empty:
        raise ValueError(f"no share of the users is left for: {', '.join(empty)}")


def chronological_split(df: DataFrame, train_frac: float = 0.6, val_frac: float = 0.2,
                        signup_col: str = "signup_timestamp", key: str = "user_id", validate: bool = True) -> DataFrame:
    """SP1: adds ``split``: first int(n*train_frac) rows by (signup, key) train, next
    int(n*val_frac) validation, the rest test. Ties in signup break by ``key``."""
    if validate:
        _check_fractions(train_frac, val_frac)

    def ends(n: Column) -> list[Column]:
        train_end = F.floor(n * F.lit(float(train_frac)))
        return [train_end, train_end + F.floor(n * F.lit(float(val_frac)))]

    last = keys_at_ranks(df, signup_col, key, ends).select(F.struct("k0", "k1").alias("_ends")).scalar()
    own = F.struct(F.col(signup_col).alias("at"), F.col(key).alias("key"))
    # a part without rows has no last key; a rank past the table cannot be (the shares' sum is at most 1)
    split = F.when(own <= last["k0"], TRAIN).when(own <= F.coalesce(last["k1"], last["k0"]), VALIDATION).otherwise(TEST)
    return df.select("*", split.alias("split"))


def split_users_and_labels(users: DataFrame, labels: DataFrame, train_frac: float = 0.6,
                           val_frac: float = 0.2) -> tuple[DataFrame, DataFrame]:
    """SP2: ranks *users* (fractions not validated, as the source does); labels follow by key.

    Returns (users with split, labels with split) - filter on ``split`` for the six frames.
    """
    u = chronological_split(users.select("user_id", "signup_timestamp"), train_frac, val_frac, validate=False)
    lab = labels.join(u.select("user_id", "split"), "user_id", "inner")
    return u, lab


def filter_split(df: DataFrame, user_splits: DataFrame, split: str) -> DataFrame:
    """SP3: rows of ``df`` whose user is in the given split (semi join)."""
    return df.join(user_splits.where(F.col("split") == split).select("user_id"), "user_id", "left_semi")


def split_report(matrix_with_split: DataFrame, signup_col: str = "signup_timestamp") -> DataFrame:
    """SP4: per split - first / last signup, rows, churn rate."""
    order = F.when(F.col("split") == TRAIN, 0).when(F.col("split") == VALIDATION, 1).otherwise(2)
    return (matrix_with_split.groupBy("split").agg(
        F.min(signup_col).alias("signup_min"), F.max(signup_col).alias("signup_max"),
        F.count(F.lit(1)).alias("rows"), F.avg(F.col(config.TARGET_COLUMN).cast("double")).alias("churn_rate"))
        .orderBy(order))
