"""What sources there are: enumeration of periods, rollups of an inventory, and how schemas change over time."""

from __future__ import annotations

import re
from collections import Counter

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quaystone.sources import scan

# First months and file names of the public trip files.
FIRST = {"yellow": (2019, 1), "hvfhv": (2019, 2)}
STEMS = {"yellow": "yellow_tripdata", "hvfhv": "fhvhv_tripdata"}
BASE = "https://d37ci6vzurychx.cloudfront.net/trip-data"


def parse_period(text: str) -> tuple[int, int]:
    """(year, month) of YYYY-MM."""
    if not re.fullmatch(r"[0-9]{4}-(0[1-9]|1[0-2])", text):
        raise ValueError(f"no period: {text!r}")
    return int(text[:4]), int(text[5:])


def parse_artifact(text: str) -> tuple[str, str]:
    """(service, period) of service:YYYY-MM."""
    service, _, period = text.partition(":")
    if service not in STEMS:
        raise ValueError(f"no service: {service!r}")
    parse_period(period)
    return service, period


def source_file(service: str, year: int, month: int) -> dict:
    parse_period(f"{year:04d}-{month:02d}")
    if (year, month) < FIRST[service]:
        raise ValueError(f"{service} begins in {FIRST[service]}")
    name = f"{STEMS[service]}_{year:04d}-{month:02d}.parquet"
    return {"filename": name, "month": month, "service": service, "url": f"{BASE}/{name}", "year": year}


def annual_files(year: int, services: tuple[str, ...] = ("yellow", "hvfhv")) -> list[dict]:
    return [source_file(s, year, m) for s in services for m in range(1, 13) if (year, m) >= FIRST[s]]


def rollup(files: DataFrame, service: str, measures: list[str]) -> DataFrame:
    """Counts and sums per service and over all (service null)."""
    return files.rollup(service).agg(F.count("*").alias("files"), *[F.sum(m).alias(m) for m in measures])


def meets_target(total_rows: int, target: int) -> dict:
    return {"meets_target": total_rows >= target, "rows": total_rows, "target_rows": target}


def event_counts(events: DataFrame, state: str) -> DataFrame:
    return events.groupBy(state).agg(F.count("*").alias("events"))


def events_by_state(events: list[dict]) -> dict[str, int]:
    return dict(sorted(Counter(e["state"] for e in events).items()))


def schema_history(columns: DataFrame, service: str, period: str, name: str, kind: str) -> DataFrame:
    """(service, period, name, change) between each period and the one before: added, removed or retyped columns.

    columns has one row per column and period; a service's first period has no changes.
    """
    periods = columns.select(service, period).distinct().withColumn("_next", F.lead(period).over(Window.partitionBy(service).orderBy(period)))
    before = columns.join(periods, [service, period]).where("_next is not null").select(service, F.col("_next").alias(period), name, F.col(kind).alias("_old"))
    after = columns.join(periods.select(service, F.col("_next").alias(period)).where(F.col(period).isNotNull()), [service, period], "left_semi").select(service, period, name, F.col(kind).alias("_new"))
    both = before.join(after, [service, period, name], "full_outer")
    change = F.when(F.col("_old").isNull(), "added").when(F.col("_new").isNull(), "removed").when(F.col("_old") != F.col("_new"), "retyped")
    return both.withColumn("change", change).where("change is not null").select(service, period, name, "change")


def first_and_last(schemas: dict[str, list[tuple[str, str]]]) -> dict:
    """Differences from each period to the next, and from the first to the last."""
    order = sorted(schemas)
    steps = {f"{a}..{b}": scan.schema_diff(schemas[a], schemas[b]) for a, b in zip(order, order[1:], strict=False)}
    return {"consecutive": steps, "first_to_last": scan.schema_diff(schemas[order[0]], schemas[order[-1]]) if order else {}}


def unique_schemas(schemas: dict[str, list[tuple[str, str]]]) -> dict[str, list[str]]:
    """Periods by schema fingerprint."""
    out: dict[str, list[str]] = {}
    for period, columns in sorted(schemas.items()):
        out.setdefault(scan.schema_fingerprint(columns), []).append(period)
    return out


def local_inventory(files: list[tuple[tuple[str, str], str]]) -> dict:
    """Footers, schema fingerprints and schema changes of local files, given as ((service, period), path); no rows are read."""
    import pyarrow.parquet as pq

    out: dict = {"files": [], "services": {}}
    schemas: dict[str, dict[str, list[tuple[str, str]]]] = {}
    for (service, period), path in sorted(files):
        columns = [(f.name, str(f.type)) for f in pq.read_schema(path)]
        schemas.setdefault(service, {})[period] = columns
        out["files"].append({"period": period, "schema_fingerprint": scan.schema_fingerprint(columns), "service": service, **scan.footer(path)})
    for service, by_period in schemas.items():
        rows = [f["rows"] for f in out["files"] if f["service"] == service]
        out["services"][service] = {"changes": first_and_last(by_period), "files": len(rows), "rows": sum(rows), "unique_schemas": len(unique_schemas(by_period))}
    return out
