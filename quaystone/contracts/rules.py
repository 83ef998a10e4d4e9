"""Rows under contract: canonical projection, two lookups of the zone dimension, nine flags, split and incidents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quaystone.contracts import types
from quaystone.functions.civiltime import Interval
from quaystone.contracts.model import Contract
from quaystone.contracts.resolve import Mapping, Resolution
from quaystone.runtime import bounded

LINEAGE = ("logical_id", "source_service", "source_period", "source_file_version_id", "source_published_at_utc", "source_logical_url", "source_content_sha256", "artifact_completeness", "contract_version", "contract_fingerprint", "derivation_id", "zone_lookup_version_id", "source_row_ordinal")
SIDES = ("pickup", "dropoff")


def quoted(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def canonical(m: Mapping) -> Column:
    """A contract column out of its source column, or a typed null."""
    value = F.lit(None) if m.status == "absent_in_source" else quoted(m.source)
    return value.cast(types.sql_name(m.target)).alias(m.name)


def out_of_guard(resolved: Resolution) -> Column:
    """Whether any guarded source value leaves its range; two comparisons, as the size of the least integer overflows."""
    flag = F.lit(False)
    for m in resolved.guarded:
        bound = types.guard_bound(m.source_kind, m.target)
        flag = flag | F.coalesce((quoted(m.source) < -bound) | (quoted(m.source) > bound), F.lit(False))
    return flag


def inside(column: Column, intervals: tuple[Interval, ...], kind: str) -> Column:
    """Whether a local time lies in an interval of a kind; the bounds are literals without zone."""
    flag = F.lit(False)
    for i in intervals:
        if i.kind == kind:
            flag = flag | ((column >= F.expr(f"timestamp_ntz'{i.start}'")) & (column < F.expr(f"timestamp_ntz'{i.end}'")))
    return F.coalesce(flag, F.lit(False))


def with_zones(df: DataFrame, zones: DataFrame, contract: Contract) -> DataFrame:
    """df with borough, zone_name, service_zone and zone_resolved of either side.

    A presence mark tells an unknown key from a zone with empty attributes; null keys meet nothing. The dimension is
    broadcast within the checked bound and joined by shuffle beyond it.
    """
    side, _ = bounded(zones.select("location_id", "borough", "zone_name", "service_zone").withColumn("present", F.lit(True)))
    for s, key in zip(SIDES, (contract.pickup_key, contract.dropoff_key), strict=True):
        own = side.select(F.col("location_id").alias("_key"), *[F.col(c).alias(f"{s}_{c}") for c in ("borough", "zone_name", "service_zone")], F.col("present").alias("_present"))
        df = df.join(own, df[key] == own["_key"], "left").withColumn(f"{s}_zone_resolved", F.coalesce("_present", F.lit(False))).drop("_key", "_present")
    return df


def flags(contract: Contract, period: str | Column, intervals: tuple[Interval, ...]) -> dict[str, Column]:
    """The nine rule flags, each true or false and never null; df has `_guard` and the zone columns."""
    up, off = F.col(contract.pickup), F.col(contract.dropoff)
    keys = [F.col(contract.pickup_key), F.col(contract.dropoff_key)]
    if isinstance(period, str):
        year, month = (int(x) for x in period.split("-"))
        outside = (F.year(up) != year) | (F.month(up) != month)
    else:  # rows of many files
        outside = F.date_format(up, "yyyy-MM") != period
    unknown = [k.isNotNull() & ~F.col(f"{s}_zone_resolved") for s, k in zip(SIDES, keys, strict=True)]
    return {
        "pickup_timestamp_missing": up.isNull(),
        "negative_duration": F.coalesce(off < up, F.lit(False)),
        "guarded_promotion_out_of_range": F.col("_guard"),
        "pickup_out_of_declared_period": F.coalesce(outside, F.lit(False)),
        "dropoff_timestamp_missing": off.isNull(),
        "zone_key_missing": keys[0].isNull() | keys[1].isNull(),
        "zone_key_unknown": unknown[0] | unknown[1],
        "local_time_nonexistent": inside(up, intervals, "nonexistent"),
        "local_time_ambiguous": inside(up, intervals, "ambiguous"),
    }


def evaluated(source: DataFrame, contract: Contract, resolved: Resolution, lineage: dict[str, object], zones: DataFrame, intervals: tuple[Interval, ...]) -> DataFrame:
    """Every source row under contract with its flags; source has source_row_ordinal.

    lineage holds constants for one file, or columns of the source where rows of many files come together.
    """
    literals = [F.lit(lineage.get(n)).alias(n) for n in LINEAGE if n != "source_row_ordinal"]
    rows = source.select(*literals, F.col("source_row_ordinal").cast("long").alias("source_row_ordinal"), *[canonical(m) for m in resolved.mappings], out_of_guard(resolved).alias("_guard"))
    rows = with_zones(rows, zones, contract)
    if not isinstance(lineage["source_period"], str):
        lineage = lineage | {"source_period": F.col("source_period")}
    rows = rows.withColumns({"pickup_local_date": F.to_date(contract.pickup), "pickup_local_hour": F.hour(contract.pickup).cast("int")})
    return rows.withColumns({f"_{n}": c for n, c in flags(contract, lineage["source_period"], intervals).items()})


def output_columns(contract: Contract) -> list[str]:
    sides = [f"{s}_{c}" for s in SIDES for c in ("borough", "zone_name", "service_zone", "zone_resolved")]
    return [*LINEAGE, *contract.names, "pickup_local_date", "pickup_local_hour", *sides]


def _quarantined(contract: Contract) -> Column:
    flag = F.lit(False)
    for r in contract.rules:
        if r.action == "quarantine":
            flag = flag | F.col(f"_{r.name}")
    return flag


def published(rows: DataFrame, contract: Contract) -> DataFrame:
    return rows.where(~_quarantined(contract)).select(*output_columns(contract))


def quarantined(rows: DataFrame, contract: Contract) -> DataFrame:
    reasons = F.array_sort(F.array_compact(F.array(*[F.when(F.col(f"_{r.name}"), F.lit(r.name)) for r in contract.rules if r.action == "quarantine"])))
    return rows.where(_quarantined(contract)).select(*output_columns(contract), reasons.alias("quarantine_reasons"))


def incident_id(*parts: Column) -> Column:
    """SHA-256 of the JSON list of the parts as text."""
    return F.sha2(F.to_json(F.array(*[p.cast("string") for p in parts])), 256)


INCIDENT = ("incident_id", "scope", "rule", "severity", "action", "logical_id", "source_service", "source_period", "source_file_version_id", "derivation_id", "source_row_ordinal", "contract_version", "detail")


def row_incidents(rows: DataFrame, contract: Contract) -> DataFrame:
    """One incident for each flag that a row raises."""
    raised = F.array_compact(F.array(*[F.when(F.col(f"_{r.name}"), F.struct(F.lit(r.name).alias("rule"), F.lit(r.severity).alias("severity"), F.lit(r.action).alias("action"))) for r in contract.rules]))
    each = rows.select("logical_id", "source_service", "source_period", "source_file_version_id", "derivation_id", "source_row_ordinal", "contract_version", F.explode(raised).alias("f")).select("*", "f.*")
    each = each.withColumns({"incident_id": incident_id(*[F.col(c) for c in ("source_file_version_id", "derivation_id", "source_row_ordinal", "rule")]), "scope": F.lit("row"), "detail": F.lit(None).cast("string")})
    return each.select(*INCIDENT)


def version_incidents(spark, resolved: Resolution, lineage: dict[str, object]) -> DataFrame:
    """One incident for each violation of a rejected file."""
    schema = ", ".join(f"{c} {'bigint' if c == 'source_row_ordinal' else 'string'}" for c in (*INCIDENT[1:], "column_name"))
    rows = [("version", v.rule, "high", "quarantine", lineage["logical_id"], lineage["source_service"], lineage["source_period"], lineage["source_file_version_id"], lineage["derivation_id"], None, lineage["contract_version"], f"{v.column}: {v.detail}", v.column) for v in resolved.violations]
    df = spark.createDataFrame(rows, schema)
    return df.withColumn("incident_id", incident_id(*[F.col(c) for c in ("derivation_id", "source_file_version_id", "rule", "column_name")])).select(*INCIDENT)


def conservation(rows: DataFrame, contract: Contract, groups: list[str]) -> DataFrame:
    """(groups..., source_rows, published_rows, quarantined_rows, conserved) from one pass over the flags."""
    held = _quarantined(contract)
    got = rows.groupBy(*groups).agg(F.count("*").alias("source_rows"), F.count(F.when(~held, 1)).alias("published_rows"), F.count(F.when(held, 1)).alias("quarantined_rows"))
    return got.withColumn("conserved", F.col("source_rows") == F.col("published_rows") + F.col("quarantined_rows"))


def conserved(source_rows: int, published_rows: int, quarantined_rows: int) -> None:
    if source_rows != published_rows + quarantined_rows:
        raise ArithmeticError(f"{source_rows} rows in, {published_rows} published and {quarantined_rows} quarantined")
