"""Reading files: physical ordinals, lineage, footers, bounded samples, the zone dimension."""

from __future__ import annotations

import csv
import os
import shutil
import uuid
from pathlib import Path

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quaystone.contracts.model import fingerprint

MANIFEST_LINEAGE = ("logical_id", "service", "period", "version_id", "content_sha256", "completeness")


def as_uri(path: str | Path) -> str:
    """A path as Spark takes it: signs stay as they are, where a quoted URI would name another file."""
    text = str(path)
    return text if "://" in text else f"file://{Path(text).absolute().as_posix()}"


def case_sensitive(spark: SparkSession) -> SparkSession:
    """A session of its own, with the caller's settings, that tells names by case: files may hold two spellings of a name, and
    matching them is the contract's business."""
    own = spark.newSession()
    for name, value in spark.conf.getAll.items():
        if spark.conf.isModifiable(name):
            own.conf.set(name, value)
    own.conf.set("spark.sql.caseSensitive", "true")
    return own


def with_ordinal(spark: SparkSession, path: str) -> DataFrame:
    """A file's rows with source_row_ordinal, the physical place given by the reader before any shuffle."""
    return spark.read.parquet(path).select("*", F.col("_metadata.row_index").cast("long").alias("source_row_ordinal"))


def occurrences(spark: SparkSession, path: str, manifest: dict, run_id: str, ingested_at: str) -> DataFrame:
    """Every physical row as it is, under (source_file_version_id, source_row_ordinal), with lineage."""
    names = {"logical_id": "logical_id", "service": "source_service", "period": "source_period", "version_id": "source_file_version_id", "content_sha256": "source_content_sha256", "completeness": "artifact_completeness"}
    literals = [F.lit(manifest.get(k)).alias(v) for k, v in names.items()]
    return with_ordinal(spark, path).select(*literals, F.lit(run_id).alias("run_id"), F.lit(ingested_at).alias("ingested_at_utc"), "*")


def ordinal_facts(df: DataFrame, groups: list[str]) -> DataFrame:
    """Counts that tell whether ordinals are dense from 0; computed with partial aggregates."""
    o = F.col("source_row_ordinal")
    facts = df.groupBy(*groups).agg(F.count("*").alias("row_count"), F.countDistinct(o).alias("distinct_ordinals"), F.min(o).alias("first_ordinal"), F.max(o).alias("last_ordinal"))
    dense = (F.col("row_count") == F.col("distinct_ordinals")) & (F.col("first_ordinal") == 0) & (F.col("last_ordinal") == F.col("row_count") - 1)
    return facts.withColumn("is_dense", dense)


def assert_dense(df: DataFrame) -> int:
    """The number of rows of a file whose ordinals are dense; an error otherwise."""
    row = ordinal_facts(df, []).first()
    if row["row_count"] and not row["is_dense"]:
        raise ValueError(f"ordinals are not dense: {row.asDict()}")
    return row["row_count"]


def untyped_columns(path: str | Path) -> frozenset[str]:
    """Columns that the footer marks as holding only nulls; Spark reads them as int."""
    return frozenset(f.name for f in pq.read_schema(path) if pa.types.is_null(f.type))


def footer(path: str | Path) -> dict:
    """Rows, row groups, creator and format version from the footer alone."""
    m = pq.read_metadata(path)
    return {"created_by": m.created_by, "format_version": m.format_version, "row_groups": m.num_row_groups, "rows": m.num_rows}


def schema_rows(df: DataFrame) -> list[tuple[int, str, str]]:
    """(ordinal, name, type) of a schema, without reading rows."""
    return [(i, f.name, f.dataType.simpleString()) for i, f in enumerate(df.schema.fields)]


def schema_fingerprint(columns: list[tuple[str, str]]) -> str:
    """Sensitive to names, types and order."""
    return fingerprint([[n, t] for n, t in columns])


def schema_diff(before: list[tuple[str, str]], after: list[tuple[str, str]]) -> dict:
    """Added and removed columns and changed types, by exact name."""
    a, b = dict(before), dict(after)
    return {"added": sorted(b.keys() - a.keys()), "removed": sorted(a.keys() - b.keys()), "retyped": sorted((n, a[n], b[n]) for n in a.keys() & b.keys() if a[n] != b[n])}


def bounded_sample(df: DataFrame, rows: int, order: list[str], path: str | None = None) -> DataFrame:
    """The first rows in an order, so that a sample can be repeated; written as one ZSTD file if a path is given."""
    sample = df.orderBy(*order).limit(rows)
    if path:
        single_file(sample, path)
    return sample


def single_file(df: DataFrame, path: str | Path) -> None:
    """Write df as one ZSTD file under the very path, replacing what was there, by renaming the one part of a write beside it.

    For results of bounded size on a file system that the driver reaches.
    """
    target = Path(str(path).removeprefix("file://"))
    aside = target.with_name(f".{target.name}.{uuid.uuid4().hex}")
    try:
        df.coalesce(1).write.option("compression", "zstd").parquet(as_uri(aside))
        parts = sorted(aside.glob("part-*.parquet"))
        if target.is_dir():
            shutil.rmtree(target)
        os.replace(parts[0], target)
    finally:
        shutil.rmtree(aside, ignore_errors=True)


ZONE_HEADER = ("LocationID", "Borough", "Zone", "service_zone")


def zone_problems(path: str | Path) -> dict:
    """Rows, missing columns, repeated ids and ids that are no whole numbers of a zone CSV."""
    with open(path, encoding="utf-8-sig", newline="") as f:
        reader = csv.DictReader(f)
        missing = [c for c in ZONE_HEADER if c not in (reader.fieldnames or [])]
        ids = [(r.get("LocationID") or "").strip() for r in reader]
    whole = [i for i in ids if i.isdigit()]
    return {"duplicate_ids": len(whole) - len({int(i) for i in whole}), "invalid_ids": len(ids) - len(whole), "missing_columns": missing, "rows": len(ids)}


def read_zones(path: str | Path) -> list[tuple[int, str, str, str]]:
    """The zone dimension sorted by id; any problem is an error, as is an empty file."""
    problems = zone_problems(path)
    if problems["missing_columns"] or problems["duplicate_ids"] or problems["invalid_ids"] or not problems["rows"]:
        raise ValueError(f"zone file {Path(path).name}: {problems}")
    with open(path, encoding="utf-8-sig", newline="") as f:
        rows = [(int(r["LocationID"]), *((r[c] or "").strip() for c in ZONE_HEADER[1:])) for r in csv.DictReader(f)]
    return sorted(rows)


def zone_frame(spark: SparkSession, rows: list[tuple[int, str, str, str]]) -> DataFrame:
    return spark.createDataFrame(rows, "location_id bigint, borough string, zone_name string, service_zone string")
