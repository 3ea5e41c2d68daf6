"""Lifecycle tables with faults that follow from the ids, to exercise every data-quality check.

The Spark frames and the SQL CTEs (``fu``, ``fe``, ``fa``, ``fiv``) below state the same faults.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _every(column: str, n: int, rest: int = 0) -> Column:
    return F.pmod(F.col(column), F.lit(n)) == rest


def _swap(column: str, when: Column, value: str | None) -> Column:
    return F.when(when, F.lit(value)).otherwise(F.col(column)).alias(column)


def faulty_users(users: DataFrame) -> DataFrame:
    """Missing users, users without events, repeated ids, bad channels, devices and consents."""
    uid = F.col("user_id")
    silent = users.where(_every("user_id", 11)).withColumn("user_id", -uid - 1_000_000)
    rows = users.where(~_every("user_id", 13, 1)).union(silent).union(users.where(_every("user_id", 17)))
    wrong = {"acquisition_channel": _swap("acquisition_channel", _every("user_id", 19), None),
             "device_type": _swap("device_type", _every("user_id", 23), "toaster"),
             "marketing_consent": F.when(~_every("user_id", 29), F.col("marketing_consent")).alias("marketing_consent")}
    return rows.select(*[wrong.get(c, F.col(c)) for c in users.columns])


def faulty_events(events: DataFrame) -> DataFrame:
    """Orphans, repeated ids, early and disordered events, null properties, values off the domains
    and too many campaign events; ``ingest_seq`` keeps the order of arrival."""
    source = F.when(_every("event_id", 73), F.lit("bot")).when(_every("event_id", 5, 1), F.lit("campaign")).otherwise(F.col("event_source"))
    name = F.when(_every("event_id", 83), F.lit("mystery")).when(~_every("event_id", 79), F.col("event_name"))
    wrong = {"user_id": F.when(_every("event_id", 97), -F.col("user_id") - 1).otherwise(F.col("user_id")).alias("user_id"),
             "event_id": F.when(_every("event_id", 89), F.col("event_id") - 1).otherwise(F.col("event_id")).alias("event_id"),
             "event_timestamp": F.when(_every("event_id", 67), F.col("event_timestamp") - F.expr("INTERVAL '2' DAY"))
             .otherwise(F.col("event_timestamp")).alias("event_timestamp"),
             "event_properties": _swap("event_properties", _every("event_id", 7), None),
             "event_name": name.alias("event_name"), "event_source": source.alias("event_source"),
             "platform": _swap("platform", _every("event_id", 71), "fridge")}
    return events.select(*[wrong.get(c, F.col(c)) for c in events.columns], F.col("event_id").alias("ingest_seq"))


def faulty_assignments(assignments: DataFrame) -> DataFrame:
    """Users without an assignment, orphans, null and unknown variants, allocations over 1."""
    variant = F.when(_every("user_id", 31), F.lit("mystery")).when(~_every("user_id", 37), F.col("variant_id"))
    wrong = {"user_id": F.when(_every("user_id", 41), F.col("user_id") + 10_000_000_000).otherwise(F.col("user_id")).alias("user_id"),
             "variant_id": variant.alias("variant_id"),
             "traffic_allocation": F.when(_every("user_id", 43), F.lit(1.5)).otherwise(F.col("traffic_allocation")).alias("traffic_allocation")}
    return assignments.where(~_every("user_id", 47, 2)).select(*[wrong.get(c, F.col(c)) for c in assignments.columns])


def faulty_interventions(interventions: DataFrame) -> DataFrame:
    """Orphans and an unknown channel."""
    wrong = {"user_id": F.when(_every("user_id", 53), -F.col("user_id") - 1).otherwise(F.col("user_id")).alias("user_id"),
             "channel": _swap("channel", _every("user_id", 59), "pigeon")}
    return interventions.select(*[wrong.get(c, F.col(c)) for c in interventions.columns])


SQL_CTES = [
    """fu AS (SELECT * REPLACE (CASE WHEN user_id % 19 <> 0 THEN acquisition_channel END AS acquisition_channel,
       CASE WHEN user_id % 23 = 0 THEN 'toaster' ELSE device_type END AS device_type,
       CASE WHEN user_id % 29 <> 0 THEN marketing_consent END AS marketing_consent)
  FROM (SELECT * FROM u WHERE user_id % 13 <> 1
        UNION ALL SELECT * REPLACE (-user_id - 1000000 AS user_id) FROM u WHERE user_id % 11 = 0
        UNION ALL SELECT * FROM u WHERE user_id % 17 = 0))""",
    """fe AS (SELECT * REPLACE (CASE WHEN event_id % 97 = 0 THEN -user_id - 1 ELSE user_id END AS user_id,
       CASE WHEN event_id % 89 = 0 THEN event_id - 1 ELSE event_id END AS event_id,
       CASE WHEN event_id % 67 = 0 THEN event_timestamp - INTERVAL 2 DAY ELSE event_timestamp END AS event_timestamp,
       CASE WHEN event_id % 7 <> 0 THEN event_properties END AS event_properties,
       CASE WHEN event_id % 83 = 0 THEN 'mystery' WHEN event_id % 79 <> 0 THEN event_name END AS event_name,
       CASE WHEN event_id % 73 = 0 THEN 'bot' WHEN event_id % 5 = 1 THEN 'campaign' ELSE event_source END AS event_source,
       CASE WHEN event_id % 71 = 0 THEN 'fridge' ELSE platform END AS platform), event_id AS ingest_seq FROM e)""",
    """fa AS (SELECT * REPLACE (CASE WHEN user_id % 41 = 0 THEN user_id + 10000000000 ELSE user_id END AS user_id,
       CASE WHEN user_id % 31 = 0 THEN 'mystery' WHEN user_id % 37 <> 0 THEN variant_id END AS variant_id,
       CASE WHEN user_id % 43 = 0 THEN 1.5 ELSE traffic_allocation END AS traffic_allocation) FROM a WHERE user_id % 47 <> 2)""",
    """fiv AS (SELECT * REPLACE (CASE WHEN user_id % 53 = 0 THEN -user_id - 1 ELSE user_id END AS user_id,
       CASE WHEN user_id % 59 = 0 THEN 'pigeon' ELSE channel END AS channel) FROM iv)""",
]
