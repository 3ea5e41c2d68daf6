"""Small helpers shared by the operators of this package."""

from __future__ import annotations

import uuid
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlens.session import apply_engine_conf, ensure_checkpoint_dir

#: The ASCII white space [\x20\x09-\x0D] that the text contracts name.
WHITE = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """A driver table, read by Spark's own reader (the path may be one that only Spark knows)."""
    apply_engine_conf(spark)
    # whole texts go to Python workers in batches that stay small when texts are long
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def kept_names(df: DataFrame, outputs: Iterable[str]) -> list[str]:
    """The columns of ``df`` that no output column replaces (in any case)."""
    gone = {n.lower() for n in outputs}
    return [c for c in df.columns if c.lower() not in gone]


def folded(df: DataFrame, names: list[str]) -> Column:
    """The named columns as one struct, so that an operator's own names cannot clash with them."""
    return F.struct(*[df[f"`{c}`"].alias(f"c{i}") for i, c in enumerate(names)]) if names else F.lit(None)


def unfolded(struct: str, names: list[str]) -> list[Column]:
    return [F.col(struct).getField(f"c{i}").alias(c) for i, c in enumerate(names)]


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased, every other character as it is. Where the text is pure ASCII, ``lower``
    does the same and is far cheaper than a per-character translation."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def sampled(share: float, *columns: str) -> Column:
    """Whether a row is in the share (below 1) of all rows, by 63 bits of its hash, so that no table
    is too long for a share over 0."""
    return F.shiftrightunsigned(F.xxhash64(*columns), 1) < F.lit(int(share * (1 << 63)))


def staged(df: DataFrame) -> DataFrame:
    """``df`` written as a table beside the session's checkpoints and read back: cuts the lineage,
    outlives executors and is compressed (a checkpoint is not)."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/table-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def cut(df: DataFrame) -> DataFrame:
    """A reliable checkpoint of a narrow frame in the session's shared checkpoint folder."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()
