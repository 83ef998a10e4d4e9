"""The verbatim slice: occurrences of landed files in one table per service, verified, replayed and held against DuckDB."""

from __future__ import annotations

from datetime import UTC, datetime
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quaystone.functions import measure
from quaystone.sources import landing, scan
from quaystone.sources.tablelog import TableLog

# The columns by which the quality metrics of each service go.
METRIC_COLUMNS = {
    "yellow": ("tpep_pickup_datetime", "tpep_dropoff_datetime", "PULocationID", "DOLocationID", ("fare_amount", "tip_amount", "total_amount")),
    "hvfhv": ("pickup_datetime", "dropoff_datetime", "PULocationID", "DOLocationID", ("base_passenger_fare", "tips", "driver_pay")),
}
VERSION, ORDINAL = "source_file_version_id", "source_row_ordinal"


class Occurrences:
    """Every physical row of every landed version, as it is."""

    def __init__(self, spark: SparkSession, warehouse: Path | str, service: str):
        self.spark, self.service = spark, service
        self.table = TableLog(Path(warehouse) / "occurrences" / f"{service}_trip")

    def ingest(self, path: Path | str, manifest: dict, run_id: str) -> dict:
        """Append one version once; ordinals must be dense, and versions of one completeness only share a table."""
        if self.table.committed(manifest["version_id"]):
            return {"state": "replayed", "rows": 0}
        if self.table.version() >= 0 and (other := self.read().where(F.col("artifact_completeness") != manifest["completeness"]).select("artifact_completeness").first()):
            raise ValueError(f"the table holds {other[0]}")
        df = scan.occurrences(self.spark, scan.as_uri(path), manifest, run_id, datetime.now(UTC).isoformat())
        rows = scan.assert_dense(df)
        return self.table.append(df, manifest["version_id"], ["source_period"]) | {"rows": rows}

    def read(self, version: str | None = None) -> DataFrame:
        """All rows, or those of one version, of which only that commit's files are opened."""
        if version is None:
            return self.table.read(self.spark)
        if len(version) != 64 or set(version) - set("0123456789abcdef"):
            raise ValueError("no version id")
        return self.table.read(self.spark, {version}).where(F.col(VERSION) == F.lit(version))

    def versions(self) -> set[str]:
        return {e["key"] for e in self.table.entries()}

    def verify(self, versions: set[str], rows: int, completeness: str) -> dict:
        """What the table holds against what it should hold; scoped to the given versions."""
        if lost := self.table.missing_files():
            raise FileNotFoundError(f"{len(lost)} files are gone")
        df = self.table.read(self.spark, versions)
        got = df.agg(F.count("*").alias("rows"), F.countDistinct(VERSION, ORDINAL).alias("keys"), F.countDistinct(VERSION).alias("versions"), F.countDistinct("artifact_completeness").alias("kinds"), F.min("artifact_completeness").alias("kind")).first()
        checks = {"rows": got["rows"] == rows, "keys": got["keys"] == rows, "versions": got["versions"] == len(versions), "completeness": got["kinds"] == 1 and got["kind"] == completeness}
        return {"checks": checks, "passed": all(checks.values()), "rows": got["rows"]}

    def metrics(self, version: str, period: str) -> dict:
        up, off, pu, do, parts = METRIC_COLUMNS[self.service]
        return self.spark.sql(measure.metrics_sql("{t}", period, up, off, pu, do, parts), t=self.read(version)).first().asDict()


def duckdb_metrics(service: str, path: Path | str, period: str) -> dict:
    """The same statement over the landed file, by an engine of its own."""
    import duckdb

    up, off, pu, do, parts = METRIC_COLUMNS[service]
    quoted = str(path).replace("'", "''")
    con = duckdb.connect()
    cur = con.execute(measure.metrics_sql(f"read_parquet('{quoted}')", period, up, off, pu, do, parts))
    row = cur.fetchone()
    return {c[0]: None if v is None else int(v) for c, v in zip(cur.description, row, strict=True)}


def duckdb_rows(service: str, path: Path | str, to: Path) -> list[str]:
    """Pickup time, pickup zone and total of each physical row, by DuckDB's own row number, as a Parquet file; the columns' names."""
    import duckdb

    up, _, pu, _, parts = METRIC_COLUMNS[service]
    quote = lambda p: str(p).replace("'", "''")
    to.parent.mkdir(parents=True, exist_ok=True)
    duckdb.connect().execute(f"COPY (SELECT file_row_number AS {ORDINAL}, {up}, {pu}, {parts[-1]} FROM read_parquet('{quote(path)}', file_row_number = true)) TO '{quote(to)}' (FORMAT parquet)")
    return [up, pu, parts[-1]]


def run(spark: SparkSession, store: landing.Store, warehouse: Path | str, identities: list[landing.Identity], run_id: str) -> dict:
    """Ingest every landed version, verify, replay, and compare metrics with DuckDB and rows with the landed file."""
    tables, report = {}, {"artifacts": [], "passed": True}
    for i in identities:
        tables.setdefault(i.service, Occurrences(spark, warehouse, i.service))
    for i in identities:
        t = tables[i.service]
        for m in store.versions(i):
            path = store.file_path(i, m["version_id"])
            first = t.ingest(path, m, run_id)
            facts = t.verify({m["version_id"]}, scan.footer(path)["rows"], i.completeness)
            before = t.table.version()
            again = t.ingest(path, m, run_id)
            compared = measure.compare(t.metrics(m["version_id"], i.period), duckdb_metrics(i.service, path, i.period))
            columns = [c for c in scan.with_ordinal(spark, scan.as_uri(path)).columns if c != ORDINAL]
            aligned = measure.alignment(t.read(m["version_id"]), scan.with_ordinal(spark, scan.as_uri(path)), ORDINAL, columns).first()["aligned"]
            own = Path(warehouse) / "_checks" / f"{m['version_id']}.parquet"
            few = duckdb_rows(i.service, path, own)
            aligned &= measure.alignment(t.read(m["version_id"]), spark.read.parquet(scan.as_uri(own)), ORDINAL, few).first()["aligned"]
            own.unlink()
            ok = facts["passed"] and again["state"] == "replayed" and t.table.version() == before and compared["match"] and aligned
            report["artifacts"].append({"aligned": aligned, "logical_id": i.logical_id, "metrics": compared, "passed": ok, "state": first["state"], "verified": facts, "version_id": m["version_id"]})
            report["passed"] &= ok
    return report


def executor_hosts(spark: SparkSession, partitions: int = 16) -> list[str]:
    """The hosts that ran a small job, for diagnosis."""
    import socket

    import pandas as pd

    hosts = spark.range(partitions, numPartitions=partitions).mapInPandas(lambda it: (pd.DataFrame({"host": [socket.gethostname()] * len(b)}) for b in it), "host string")
    return sorted(r[0] for r in hosts.distinct().collect())
