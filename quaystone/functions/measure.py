"""Quality metrics, digests that do not depend on row order, and comparison of two measurements."""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Folds of so many values at most, on average, are sorted together.
FOLD = 4096


def row_metrics(period: str, pickup: str, dropoff: str, pickup_key: str, dropoff_key: str) -> dict[str, str]:
    """What makes a row count, by metric; a null pickup counts as out of period here."""
    year, month = (int(x) for x in period.split("-"))
    return {
        "source_rows": "true",
        "null_pickup_zone_rows": f"{pickup_key} IS NULL",
        "null_dropoff_zone_rows": f"{dropoff_key} IS NULL",
        "pickup_out_of_period_rows": f"coalesce(year({pickup}) <> {year} OR month({pickup}) <> {month}, true)",
        "negative_duration_rows": f"{dropoff} < {pickup}",
        "unresolved_duration_rows": f"{pickup} IS NULL OR {dropoff} IS NULL",
    }


def component_metrics(component: str) -> dict[str, str]:
    """The sums of a fare component, by metric; a sum of nothing is null."""
    return {f"{component}_non_null_rows": f"count({component})", f"{component}_sum_cents": f"sum(CAST(round({component} * 100) AS BIGINT))"}


def metric_names(components: tuple[str, ...]) -> list[str]:
    return [*row_metrics("2000-01", "", "", "", ""), *[n for c in components for n in component_metrics(c)]]


def metrics_sql(relation: str, period: str, pickup: str, dropoff: str, pickup_key: str, dropoff_key: str, components: tuple[str, ...]) -> str:
    """One statement that Spark and DuckDB both run."""
    parts = {n: f"count(CASE WHEN {test} THEN 1 END)" for n, test in row_metrics(period, pickup, dropoff, pickup_key, dropoff_key).items()}
    for c in components:
        parts |= component_metrics(c)
    return "SELECT " + ", ".join(f"CAST({x} AS BIGINT) AS {n}" for n, x in parts.items()) + f" FROM {relation}"


def _stable(df: DataFrame, column: str) -> Column:
    """A column as it enters a digest: times as microseconds, which JSON would cut to milliseconds."""
    kind = df.schema[column].dataType
    c = F.col("`" + column + "`")
    if isinstance(kind, (T.TimestampNTZType, T.TimestampType)):
        return F.unix_micros(c.cast("timestamp")).alias(column)
    return c.alias(column)


def row_text(df: DataFrame, columns: list[str] | None = None) -> Column:
    """A row as JSON with its columns in the order of their names, nulls kept."""
    return F.to_json(F.struct(*[_stable(df, c) for c in sorted(columns or df.columns)]), {"ignoreNullFields": "false"})


def row_hashes(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    return df.select(F.sha2(row_text(df, columns), 256).alias("h"))


def additive_digest(hashes: DataFrame) -> DataFrame:
    """(row_count, digest): the sum of each hash's first 15 hex digits; a checksum, null on no rows."""
    return hashes.agg(F.count("*").alias("row_count"), F.sum(F.conv(F.substring("h", 1, 15), 16, 10).cast("decimal(38,0)")).cast("string").alias("digest"))


def _folded(hashes: DataFrame, by: list[str], rows: int) -> DataFrame:
    """(by..., row_count, digest) of hashes `h`, folded by as many leading digits as `rows` asks for, level by level."""
    digits = 4
    while rows > FOLD * 16**digits:
        digits += 2
    fold = lambda c: F.sha2(F.array_join(F.array_sort(F.collect_list(c)), "\n"), 256)
    counted = hashes.groupBy(*by, "h").agg(F.count("*").alias("n"))
    level = counted.groupBy(*by, F.substring("h", 1, digits).alias("b")).agg(F.sum("n").alias("n"), fold(F.concat_ws(":", "h", F.col("n").cast("string"))).alias("f"))
    for width in range(digits - 2, 0, -2):
        level = level.groupBy(*by, F.substring("b", 1, width).alias("b")).agg(F.sum("n").alias("n"), fold(F.concat_ws(":", "b", "f")).alias("f"))
    return level.groupBy(*by).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("row_count"), fold(F.concat_ws(":", "b", "f")).alias("digest"))


def sorted_digest(hashes: DataFrame) -> DataFrame:
    """(row_count, digest): exact for the multiset of rows, whatever its order and size.

    Equal hashes are counted before the shuffle and folded by leading digits, as many as keep a fold at FOLD hashes whatever
    the number of rows; then 256 folds become one, level by level. The number of rows decides the levels, so equal multisets
    have equal ones.
    """
    return _folded(hashes, [], hashes.count())


def key_digest(df: DataFrame, keys: list[str]) -> DataFrame:
    """(distinct_keys, digest) of the distinct keys."""
    return additive_digest(row_hashes(df.select(*keys).distinct())).withColumnRenamed("row_count", "distinct_keys")


def signature(df: DataFrame) -> list[str]:
    return [f"{f.name}:{f.dataType.simpleString()}" for f in df.schema.fields]


def measure(df: DataFrame, keys: list[str]) -> dict:
    """Schema, rows, distinct keys, and both digests of the rows and of the distinct keys, so that copies that differ can be
    told to differ in keys or only in values."""
    hashes = df.select(F.sha2(row_text(df), 256).alias("h"), F.sha2(row_text(df, keys), 256).alias("k"))
    number = lambda c: F.conv(F.substring(c, 1, 15), 16, 10).cast("decimal(38,0)")
    by_key = hashes.groupBy("k").agg(F.count("*").alias("n"), F.sum(number("h")).alias("s"))
    sums = by_key.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("rows"), F.count("*").alias("keys"), F.sum("s").cast("string").alias("rows_sum"), F.sum(number("k")).cast("string").alias("keys_sum")).first()
    both = hashes.select(F.lit("row").alias("kind"), "h").unionByName(by_key.select(F.lit("key").alias("kind"), F.col("k").alias("h")))
    exact = {r["kind"]: r["digest"] for r in _folded(both, ["kind"], sums["rows"]).collect()}
    nothing = hashlib.sha256(b"").hexdigest()
    return {
        "schema": signature(df), "rows": sums["rows"], "distinct_keys": sums["keys"], "additive_digest": sums["rows_sum"], "sorted_digest": exact.get("row", nothing),
        "key_additive_digest": sums["keys_sum"], "key_sorted_digest": exact.get("key", nothing),
    }


def compare(left: dict, right: dict) -> dict:
    """Field by field over the union of names; equal only if there is something and all of it is equal."""
    fields = {k: {"left": left.get(k), "right": right.get(k), "match": left.get(k) == right.get(k)} for k in sorted(left.keys() | right.keys())}
    return {"fields": fields, "match": bool(fields) and all(f["match"] for f in fields.values())}


def unpivoted(df: DataFrame, names: list[str]) -> DataFrame:
    """One row of metrics as (metric, value)."""
    return df.select(F.explode(F.array(*[F.struct(F.lit(n).alias("metric"), F.col(n).cast("long").alias("value")) for n in names])).alias("x")).select("x.*")


def compare_metrics(left: DataFrame, right: DataFrame) -> DataFrame:
    """(metric, left_value, right_value, matches) over the union of metrics; nulls match nulls."""
    a, b = left.withColumnRenamed("value", "left_value"), right.withColumnRenamed("value", "right_value")
    return a.join(b, "metric", "full_outer").select("metric", "left_value", "right_value", F.col("left_value").eqNullSafe(F.col("right_value")).alias("matches"))


def alignment(left: DataFrame, right: DataFrame, key: str, values: list[str]) -> DataFrame:
    """(left_rows, right_rows, first_mismatch, aligned) of two copies by ordinal; empty copies are not aligned."""
    a = left.select(F.col(key).alias("k"), F.struct(*values).alias("a"))
    b = right.select(F.col(key).alias("k"), F.struct(*values).alias("b"))
    differs = ~F.col("a").eqNullSafe(F.col("b"))
    got = a.join(b, "k", "full_outer").agg(F.count("a").alias("left_rows"), F.count("b").alias("right_rows"), F.min(F.when(differs, F.col("k"))).alias("first_mismatch"))
    return got.withColumn("aligned", (F.col("left_rows") == F.col("right_rows")) & (F.col("left_rows") > 0) & F.col("first_mismatch").isNull())
