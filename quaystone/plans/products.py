"""Products that the public design declares but does not build: extensions beyond parity."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def zone_hour_demand(trips: DataFrame, zone: str, at: str) -> DataFrame:
    """Trips per zone, local date and hour."""
    return trips.where(F.col(at).isNotNull()).groupBy(F.col(zone).alias("zone_id"), F.to_date(at).alias("local_date"), F.hour(at).alias("local_hour")).agg(F.count("*").alias("trips"))


def fare_day(trips: DataFrame, at: str, components: list[str]) -> DataFrame:
    """Sums in cents per day, each with its own count of known values; components are never added to one another."""
    parts: list[Column] = []
    for c in components:
        parts += [F.count(c).alias(f"{c}_rows"), F.sum(F.round(F.col(c) * 100).cast("bigint")).alias(f"{c}_cents")]
    return trips.groupBy(F.to_date(at).alias("local_date")).agg(F.count("*").alias("trips"), *parts)


def coverage(required: DataFrame, covered: DataFrame, key: str) -> DataFrame:
    """(required, covered, missing) counts of artifacts."""
    marked = required.select(key).distinct().join(covered.select(key).distinct().withColumn("_c", F.lit(1)), key, "left")
    return marked.agg(F.count("*").alias("required"), F.count("_c").alias("covered"), F.sum(F.when(F.col("_c").isNull(), 1).otherwise(0)).alias("missing"))


def incident_summary(incidents: DataFrame) -> DataFrame:
    return incidents.groupBy("rule", "severity", "action").agg(F.count("*").alias("incidents"))


def dimensional(trips: DataFrame, at: str, zone: str, service: str, versions: list[str]) -> dict[str, DataFrame]:
    """A trip fact with date keys, and the date, zone, service and source-version dimensions it refers to."""
    fact = trips.withColumn("date_key", F.date_format(at, "yyyyMMdd").cast("int"))
    date = fact.where("date_key is not null").select("date_key", F.to_date(at).alias("local_date")).distinct()
    return {"fact": fact, "date": date.withColumns({"year": F.year("local_date"), "month": F.month("local_date"), "weekday": F.dayofweek("local_date")}), "zone": fact.select(zone).distinct(), "service": fact.select(service).distinct(), "source_version": fact.select(*versions).distinct()}
