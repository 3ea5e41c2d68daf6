"""Table readers (IO1) and timestamp coercion (IO2)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortlens.sources import schemas

TIMESTAMP_COLUMNS = {
    "users": ["signup_timestamp"],
    "events": ["event_timestamp"],
    "experiment_assignments": ["assignment_time"],
    "interventions": ["send_time", "open_time", "click_time", "conversion_time"],
    "labels": ["signup_timestamp", "prediction_cutoff", "label_start", "label_end"],
}


def read_table(spark: SparkSession, path: str, table: str, fmt: str = "parquet") -> DataFrame:
    """IO1: read one lifecycle table with its declared schema (never inferred).

    CSV is read as text with the declared columns and then coerced, so ISO timestamps with or
    without a zone suffix parse the same way; parquet uses the declared schema directly.
    """
    schema = schemas.TABLES[table]
    if fmt == "csv":
        text_schema = T.StructType([T.StructField(f.name, T.StringType(), True) for f in schema.fields])
        df = spark.read.schema(text_schema).option("header", True).csv(path)
        return conform(df, schema)
    return spark.read.schema(schema).format(fmt).load(path)


def read_tables(spark: SparkSession, root: str, fmt: str = "parquet") -> dict[str, DataFrame]:
    """Read the five tables laid out as ``<root>/<table>.<fmt>``."""
    return {name: read_table(spark, f"{root}/{name}.{fmt}", name, fmt) for name in schemas.TABLES}


def coerce_timestamps(df: DataFrame, columns: list[str]) -> DataFrame:
    """IO2: parse string columns into ``timestamp_ntz`` (UTC wall clock); typed columns pass through."""
    out = df
    for c in columns:
        if c not in df.columns:
            continue
        dtype = df.schema[c].dataType
        if isinstance(dtype, T.TimestampNTZType):
            continue
        if isinstance(dtype, T.TimestampType):
            out = out.withColumn(c, F.col(c).cast(T.TimestampNTZType()))
            continue
        # a text with a zone names an instant, converted to UTC wall time; one without is wall time
        text = F.regexp_replace(F.trim(F.col(c).cast("string")), r"([+-]\d{2}):?(\d{2})$", "$1:$2")
        zoned = text.rlike(r":\d{2}.*(Z|[+-]\d{2}:\d{2})$")
        instant = F.convert_timezone(F.current_timezone(), F.lit("UTC"), F.to_timestamp(F.when(zoned, text)).cast("timestamp_ntz"))
        out = out.withColumn(c, F.coalesce(instant, F.to_timestamp_ntz(F.when(~zoned, F.regexp_replace(text, "T", " ")))))
    return out


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Cast a text frame to the declared schema, timestamps via :func:`coerce_timestamps`."""
    ts_cols = [f.name for f in schema.fields if isinstance(f.dataType, T.TimestampNTZType)]
    out = coerce_timestamps(df, ts_cols)
    casts = []
    for f in schema.fields:
        if f.name not in out.columns:
            casts.append(F.lit(None).cast(f.dataType).alias(f.name))
        elif f.name in ts_cols:
            casts.append(F.col(f.name))
        elif isinstance(f.dataType, T.BooleanType):
            casts.append(F.lower(F.col(f.name).cast("string")).isin("true", "1", "t", "yes").alias(f.name))
        else:
            casts.append(F.col(f.name).cast(f.dataType).alias(f.name))
    return out.select(*casts)
