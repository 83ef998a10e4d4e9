"""One registered query per contract operator over the trip tables, with the same in SQL."""

from __future__ import annotations

import atexit
import csv
import shutil
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quaystone.contracts import resolve, rules, versions
from quaystone.contracts.model import HVFHV, YELLOW, Contract
from quaystone.functions import measure
from quaystone.functions.civiltime import Interval, transitions
from quaystone.operators import drift
from quaystone.operators.schema_tree import RANK
from quaystone.plans import products
from quaystone.plans.pipeline import Lake, together
from quaystone.runtime import shared_dir, table
from quaystone.sources import inventory, scan

YEARS, ZONES, PERIOD = range(2022, 2027), "zones-1", "2024-03"
INTERVALS: tuple[Interval, ...] = tuple(i for y in YEARS for m in range(1, 13) for i in transitions(y, m, YELLOW.zone))
KEY = ["source_file_version_id", "source_row_ordinal"]


def _evaluated(spark: SparkSession, d: str, name: str = "yellow_trip", contract: Contract = YELLOW, guard: bool = False) -> DataFrame:
    source = table(spark, d, name)
    if guard:  # a whole-number count that partly leaves the range of exact doubles
        source = source.withColumn("passenger_count", F.col("vendorid") * F.lit(4503599627370496))
    resolved = resolve.resolve(contract, resolve.of_struct(source.schema))
    version, print_ = F.col("source_file_version_id"), contract.fingerprint()
    derived = versions.derivation_of(version, print_, ZONES)
    lineage = {
        "logical_id": F.concat_ws(":", F.lit("trip"), F.lit("synthetic_fixture"), F.lit(contract.service), "source_period"), "source_service": contract.service, "source_period": F.col("source_period"), "source_file_version_id": version,
        "source_published_at_utc": F.col("ingested_at_utc").cast("string"), "source_content_sha256": version, "artifact_completeness": "synthetic_fixture", "contract_version": contract.version, "contract_fingerprint": print_, "derivation_id": derived, "zone_lookup_version_id": ZONES,
    }
    return rules.evaluated(source, contract, resolved, lineage, table(spark, d, "zone_lookup"), INTERVALS)


def _folder(spark: SparkSession, label: str) -> Path:
    """A folder for one query's files, in the shared folder, which has to be a mounted one here; removed when the driver ends."""
    base = shared_dir(spark).removeprefix("file://")
    path = Path(base) / f"quaystone-{label}-{uuid.uuid4().hex}"
    path.mkdir(parents=True)
    atexit.register(shutil.rmtree, path, True)
    return path


# -- scans ------------------------------------------------------------------------------------------------------------


def occurrence_scan(spark, d):
    """Rows of one file with their physical ordinals."""
    return scan.with_ordinal(spark, f"{d}/events.parquet").select("event_id", "source_row_ordinal")


def dense_ordinals(spark, d):
    """Whether each yellow file's ordinals are dense from 0."""
    return scan.ordinal_facts(table(spark, d, "yellow_trip").select(*KEY).distinct(), ["source_file_version_id"])


def _schema(spark, d, name):
    return [(n, t) for _, n, t in scan.schema_rows(table(spark, d, name))]


def schema_profile(spark, d):
    return spark.createDataFrame(scan.schema_rows(table(spark, d, "yellow_trip")), "ordinal int, column_name string, column_type string")


def schema_diff(spark, d):
    got = scan.schema_diff(_schema(spark, d, "yellow_trip"), _schema(spark, d, "hvfhv_trip"))
    rows = [(n, "added") for n in got["added"]] + [(n, "removed") for n in got["removed"]] + [(n, "retyped") for n, _, _ in got["retyped"]]
    return spark.createDataFrame(rows, "column_name string, change string")


def schema_fingerprint(spark, d):
    return spark.createDataFrame([(t, scan.schema_fingerprint(_schema(spark, d, t))) for t in ("yellow_trip", "hvfhv_trip")], "table_name string, fingerprint string")


def bounded_sample(spark, d):
    return scan.bounded_sample(table(spark, d, "events").select("event_id", "user_id", "value"), 1000, ["event_id"])


def version_filter(spark, d):
    """Rows of the file with the least id, selected by a pushed-down equality."""
    trips = table(spark, d, "published_trip")
    first = trips.agg(F.min("source_file_version_id")).first()[0]
    return trips.where(F.col("source_file_version_id") == F.lit(first)).select("source_file_version_id", "source_row_ordinal", "fare_amount")


def distinct_versions(spark, d):
    return table(spark, d, "yellow_trip").select("source_file_version_id").distinct()


# -- projection and rules ---------------------------------------------------------------------------------------------


def contract_project(spark, d):
    source = table(spark, d, "hvfhv_trip")
    resolved = resolve.resolve(HVFHV, resolve.of_struct(source.schema))
    return source.select(*KEY, *[rules.canonical(m) for m in resolved.mappings])


def rule_flags(spark, d):
    return _evaluated(spark, d).select(*KEY, *[F.col(f"_{r.name}").alias(r.name) for r in YELLOW.rules])


def guarded_promotion(spark, d):
    return _evaluated(spark, d, guard=True).where("_guard").select(*KEY, "passenger_count")


def local_date_hour(spark, d):
    return _evaluated(spark, d).select(*KEY, F.col("pickup_local_date").cast("string").alias("pickup_local_date"), "pickup_local_hour")


def local_time_flags(spark, d):
    return _evaluated(spark, d).where("_local_time_nonexistent or _local_time_ambiguous").select(*KEY, F.col("_local_time_nonexistent").alias("nonexistent"), F.col("_local_time_ambiguous").alias("ambiguous"))


def _zone_file(spark, d) -> Path:
    """The zone lookup as the CSV file in which it is landed, with stray blanks."""
    path = _folder(spark, "zones") / "zones.csv"
    with path.open("w", encoding="utf-8-sig", newline="") as f:
        out = csv.writer(f)
        out.writerow(scan.ZONE_HEADER)
        for r in table(spark, d, "zone_lookup").select("location_id", "borough", "zone_name", "service_zone").toLocalIterator():
            out.writerow([f" {x} " if x is not None else "" for x in r])
    return path


def zone_dimension(spark, d):
    """The zone dimension as read and checked from its file."""
    return scan.zone_frame(spark, scan.read_zones(_zone_file(spark, d)))


def zone_validation(spark, d):
    got = scan.zone_problems(_zone_file(spark, d))
    return spark.createDataFrame([(got["rows"], got["duplicate_ids"], got["invalid_ids"], len(got["missing_columns"]))], "row_count bigint, duplicate_ids bigint, invalid_ids bigint, missing_columns int")


def zone_join(spark, d):
    return _evaluated(spark, d).select(*KEY, "pickup_borough", "pickup_zone_name", "pickup_zone_resolved", "dropoff_borough", "dropoff_zone_name", "dropoff_zone_resolved")


def zone_key_unknown(spark, d):
    return _evaluated(spark, d).where("_zone_key_unknown").select(*KEY, "pickup_location_id", "dropoff_location_id")


def contracted_rows(spark, d):
    return rules.published(_evaluated(spark, d, guard=True), YELLOW).select(*KEY, "derivation_id", "source_period", *YELLOW.names, "pickup_local_hour", "pickup_zone_resolved")


def quarantine_rows(spark, d):
    return rules.quarantined(_evaluated(spark, d, guard=True), YELLOW).select(*KEY, F.array_join("quarantine_reasons", ",").alias("reasons"))


def row_incidents(spark, d):
    return rules.row_incidents(_evaluated(spark, d, guard=True), YELLOW).groupBy("source_file_version_id", "rule", "severity", "action").agg(F.count("*").alias("incidents"))


def incident_ids(spark, d):
    return rules.row_incidents(_evaluated(spark, d), YELLOW).select(*KEY, "rule", "incident_id")


def incident_summary(spark, d):
    return products.incident_summary(rules.row_incidents(_evaluated(spark, d), YELLOW))


def row_conservation(spark, d):
    return rules.conservation(_evaluated(spark, d, guard=True), YELLOW, ["source_file_version_id"])


def derivation_id(spark, d):
    return table(spark, d, "artifact_manifest").select("source_file_version_id", versions.derivation_of(F.col("source_file_version_id"), YELLOW.fingerprint(), ZONES).alias("derivation_id"))


# -- metrics and digests ----------------------------------------------------------------------------------------------

_YELLOW_COMPONENTS, _HVFHV_COMPONENTS = ("fare_amount", "tip_amount", "total_amount"), ("base_passenger_fare", "tips", "driver_pay")


def _metrics_sql(service: str, relation: str | None = None) -> str:
    if service == "yellow":
        return measure.metrics_sql(relation or "yellow_trip", PERIOD, "tpep_pickup_datetime", "tpep_dropoff_datetime", "pulocationid", "dolocationid", _YELLOW_COMPONENTS)
    return measure.metrics_sql(relation or "hvfhv_trip", PERIOD, "pickup_datetime", "dropoff_datetime", "pulocationid", "dolocationid", _HVFHV_COMPONENTS)


def quality_metrics_yellow(spark, d):
    return spark.sql(_metrics_sql("yellow", "{t}"), t=table(spark, d, "yellow_trip"))


def quality_metrics_hvfhv(spark, d):
    return spark.sql(_metrics_sql("hvfhv", "{t}"), t=table(spark, d, "hvfhv_trip"))


def table_totals(spark, d):
    t = table(spark, d, "yellow_trip")
    return t.agg(F.count("*").alias("row_count"), F.countDistinct(*KEY).alias("distinct_rows"), F.countDistinct("source_file_version_id").alias("files"), F.min("source_period").alias("first_period"))


_DIGESTED = ["source_file_version_id", "source_row_ordinal", "pickup_location_id", "payment_type", "store_and_fwd_flag"]


def additive_digest(spark, d):
    return measure.additive_digest(measure.row_hashes(table(spark, d, "published_trip"), _DIGESTED))


def sorted_digest(spark, d):
    return measure.sorted_digest(measure.row_hashes(table(spark, d, "published_trip"), _DIGESTED))


def key_digest(spark, d):
    return measure.key_digest(table(spark, d, "published_trip"), KEY)


def _trip_metrics(df: DataFrame) -> DataFrame:
    return measure.unpivoted(df.agg(F.count("*").alias("row_count"), F.count("fare_amount").alias("fares"), F.sum(F.round(F.col("fare_amount") * 100).cast("bigint")).alias("fare_cents"), F.countDistinct("derivation_id").alias("derivations")), ["row_count", "fares", "fare_cents", "derivations"])


def metric_compare(spark, d):
    return measure.compare_metrics(_trip_metrics(table(spark, d, "published_trip")), _trip_metrics(table(spark, d, "rebuilt_trip")))


def ordinal_alignment(spark, d):
    sides = []
    for name in ("published_trip", "rebuilt_trip"):
        sides.append(table(spark, d, name).withColumn("k", F.concat_ws(":", "source_file_version_id", F.lpad(F.col("source_row_ordinal").cast("string"), 12, "0"))).select("k", "payment_type", "store_and_fwd_flag").distinct())
    return measure.alignment(sides[0], sides[1], "k", ["payment_type", "store_and_fwd_flag"])


def row_alignment(spark, d):
    """As ordinal_alignment, over every column but the key."""
    sides = []
    for name in ("published_trip", "rebuilt_trip"):
        t = table(spark, d, name)
        k = F.concat_ws(":", "source_file_version_id", F.lpad(F.col("source_row_ordinal").cast("string"), 12, "0"))
        sides.append(t.select(k.alias("k"), *[c for c in t.columns if c not in KEY]).repartition("k").distinct())  # one shuffle serves the join too
    return measure.alignment(sides[0], sides[1], "k", sides[0].columns[1:])


def promotion_profile(spark, d):
    """Promotions of a file that stores counts as whole numbers and codes and distances narrower than the contract."""
    source = table(spark, d, "yellow_trip").selectExpr("* except (vendorid, payment_type, trip_distance, passenger_count)", "cast(vendorid as int) vendorid", "cast(payment_type as smallint) payment_type", "cast(trip_distance as float) trip_distance", "cast(passenger_count as bigint) passenger_count")
    got = resolve.resolve(YELLOW, resolve.of_struct(source.schema))
    return spark.createDataFrame([(k, len(v)) for k, v in got.promotions().items()], "promotion string, columns bigint")


def rule_flags_hvfhv(spark, d):
    return _evaluated(spark, d, "hvfhv_trip", HVFHV).select(*KEY, *[F.col(f"_{r.name}").alias(r.name) for r in HVFHV.rules])


def contracted_rows_hvfhv(spark, d):
    return rules.published(_evaluated(spark, d, "hvfhv_trip", HVFHV), HVFHV).select(*KEY, "derivation_id", "source_period", "contract_version", *HVFHV.names, "pickup_local_hour", "pickup_zone_resolved")


# -- versions ---------------------------------------------------------------------------------------------------------


def _candidates(spark, d):
    """Orders as files of their customers: a status stands for a violation."""
    return table(spark, d, "orders").select("o_custkey", "o_orderkey", "o_orderdate", (F.col("o_orderstatus") != "F").alias("clean"))


def version_selection(spark, d):
    return versions.decisions(_candidates(spark, d), "o_custkey", "o_orderkey", "o_orderdate", "clean").select("o_custkey", "o_orderkey", "decision")


def ledger_state(spark, d):
    """Active version per user after replaying events: purchases activate, other types end."""
    e = table(spark, d, "events").select("event_id", "user_id", (F.col("event_id") % 50).alias("version"), F.when(F.col("event_id") % 3 == 0, "activated").otherwise("superseded").alias("action"))
    return versions.ledger_state(e, "user_id", "event_id", "version", "action")


def ledger_reconcile(spark, d):
    """Decisions of today that differ from a ledger that knows only orders before 1998."""
    what = ["decision"]
    now = versions.decisions(_candidates(spark, d), "o_custkey", "o_orderkey", "o_orderdate", "clean").select("o_custkey", "o_orderkey", "decision")
    old = versions.decisions(_candidates(spark, d).where("o_orderdate < timestamp_ntz'1998-01-01'"), "o_custkey", "o_orderkey", "o_orderdate", "clean").select("o_custkey", "o_orderkey", F.lit(1).alias("seq"), "decision")
    return versions.ledger_changes(now, old, ["o_custkey", "o_orderkey"], "seq", what)


def _active_files(spark, d, kinds: tuple[str, ...] = ("contracted",)):
    m = table(spark, d, "artifact_manifest").where(F.col("artifact_kind").isin(*kinds))
    return versions.newest(m, "logical_id", "source_file_version_id", "published_at_utc")


def _published_lake(spark, d, rows: bool) -> Lake:
    """The contracted files as a published warehouse: a marker each, and if wanted one commit of published_trip's rows each.

    Files of raw trips, which nothing published yet, are marked under an older contract.
    """
    root = _folder(spark, "lake")
    lake, trips, now = Lake(spark, root / "landing", root / "warehouse"), table(spark, d, "published_trip"), YELLOW.fingerprint()
    files = table(spark, d, "artifact_manifest").where("artifact_kind in ('contracted', 'trip')").select("logical_id", "artifact_kind", "source_period", "source_file_version_id", "published_at_utc").distinct().collect()
    lake.catalog.prepare_layout()

    def mark(f) -> None:
        print_ = now if f["artifact_kind"] == "contracted" else "0" * 64
        lake.catalog.publish(versions.Marker(f["logical_id"], "yellow", f["source_period"], f["source_file_version_id"], f["published_at_utc"].isoformat(), "active", print_, ZONES, versions.derivation_id(f["source_file_version_id"], print_, ZONES)))

    together(mark, files)
    lake.catalog.settle(versions.Boundary(ZONES, {"yellow": now}))

    if rows:
        keys = {f["source_file_version_id"]: f"yellow:trip:{versions.derivation_id(f['source_file_version_id'], now, ZONES)}" for f in files if f["artifact_kind"] == "contracted"}
        lake.table(YELLOW, "trip").append_each(trips, "source_file_version_id", keys, ["source_period"])
    return lake


def published_view(spark, d):
    """What readers see of a warehouse: the rows of the newest file of each artifact, of all that were committed."""
    return _published_lake(spark, d, True).read("yellow", "trip").select("source_file_version_id", "source_row_ordinal", "derivation_id", "fare_amount")


def coverage(spark, d):
    """Artifacts that the boundary requires, and whether it covers them."""
    got = _published_lake(spark, d, False).coverage([])
    return spark.createDataFrame([(x, True) for x in got["covered"]] + [(x, False) for x in got["missing"]], "logical_id string, covered boolean")


def coverage_summary(spark, d):
    return products.coverage(_active_files(spark, d), table(spark, d, "published_trip"), "source_file_version_id")


def inventory_rollup(spark, d):
    return inventory.rollup(table(spark, d, "artifact_manifest"), "source_service", ["content_length_bytes"])


def event_counts(spark, d):
    return inventory.event_counts(table(spark, d, "artifact_manifest"), "publication_state")


def schema_change_history(spark, d):
    """Changes of the payloads' fields from period to period of each raw feed."""
    raw = drift.file_schemas(table(spark, d, "raw_record"), "source_file_version_id", "payload").select("source_file_version_id", drift.shape_text(F.col("schema")).alias("text"))
    fields = drift.shape_nodes(raw).where("size(path) = 1")
    files = table(spark, d, "artifact_manifest").where("artifact_kind = 'raw' and source_period is not null").select("source_file_version_id", F.col("feed_id").cast("string").alias("feed"), "source_period").distinct()
    rank = F.coalesce(*[F.when(F.col("kind") == k, F.lit(r)) for k, r in RANK.items()], F.lit(RANK["text"]))
    cells = raw.withColumn("shape", F.md5("text")).join(fields, "shape").join(files, "source_file_version_id").groupBy("feed", "source_period", F.col("path")[0].alias("field_name")).agg(F.max(rank).alias("kind"))
    return inventory.schema_history(cells, "feed", "source_period", "field_name", "kind")


# -- products ---------------------------------------------------------------------------------------------------------


def zone_hour_demand(spark, d):
    return products.zone_hour_demand(table(spark, d, "yellow_trip"), "pulocationid", "tpep_pickup_datetime").withColumn("local_date", F.col("local_date").cast("string"))


def fare_day(spark, d):
    return products.fare_day(table(spark, d, "hvfhv_trip"), "pickup_datetime", ["base_passenger_fare", "tips", "driver_pay"]).withColumn("local_date", F.col("local_date").cast("string"))


def fare_day_yellow(spark, d):
    return products.fare_day(table(spark, d, "yellow_trip"), "tpep_pickup_datetime", list(YELLOW.components)).withColumn("local_date", F.col("local_date").cast("string"))


def _dimensions(spark, d):
    return products.dimensional(table(spark, d, "hvfhv_trip"), "pickup_datetime", "pulocationid", "hvfhs_license_num", ["source_file_version_id", "feed_id", "source_period"])


def dimensional_dates(spark, d):
    return _dimensions(spark, d)["date"].withColumn("local_date", F.col("local_date").cast("string"))


def dimensional_zones(spark, d):
    return _dimensions(spark, d)["zone"]


def dimensional_services(spark, d):
    return _dimensions(spark, d)["service"]


def dimensional_versions(spark, d):
    return _dimensions(spark, d)["source_version"]


QUERIES = {
    f.__name__: f
    for f in (
        occurrence_scan, dense_ordinals, schema_profile, schema_diff, schema_fingerprint, bounded_sample, version_filter, distinct_versions, contract_project, rule_flags, guarded_promotion, local_date_hour, local_time_flags,
        zone_dimension, zone_validation, zone_join, zone_key_unknown, contracted_rows, quarantine_rows, row_incidents, incident_ids, incident_summary, row_conservation, derivation_id, quality_metrics_yellow, quality_metrics_hvfhv,
        table_totals, additive_digest, sorted_digest, key_digest, metric_compare, ordinal_alignment, row_alignment, promotion_profile, version_selection, ledger_state, ledger_reconcile, published_view, coverage, coverage_summary,
        inventory_rollup, event_counts, schema_change_history, zone_hour_demand, fare_day, fare_day_yellow, dimensional_dates, dimensional_zones, dimensional_services, dimensional_versions, rule_flags_hvfhv, contracted_rows_hvfhv,
    )
}

# -- SQL --------------------------------------------------------------------------------------------------------------

_TYPE = "CASE column_type WHEN 'VARCHAR' THEN 'string' WHEN 'BIGINT' THEN 'bigint' WHEN 'DOUBLE' THEN 'double' WHEN 'TIMESTAMP' THEN 'timestamp_ntz' WHEN 'TIMESTAMP WITH TIME ZONE' THEN 'timestamp' ELSE column_type END"
_DESCRIBE = "SELECT row_number() OVER () - 1 AS ordinal, column_name, " + _TYPE + " AS column_type FROM (DESCRIBE {t})"


def _between(kind: str) -> str:
    tests = [f"(pickup >= TIMESTAMP '{i.start}' AND pickup < TIMESTAMP '{i.end}')" for i in INTERVALS if i.kind == kind]
    return f"coalesce({' OR '.join(tests)}, false)"


def _flag_sql(guard: bool, service: str = "yellow") -> str:
    if service == "hvfhv":
        text = _flag_sql(False).replace("yellow_trip", "hvfhv_trip").replace("tpep_", "").replace(YELLOW.fingerprint(), HVFHV.fingerprint())
        return text.replace("CAST(passenger_count AS DOUBLE) AS riders, ", "")
    count = "vendorid * 4503599627370496" if guard else "passenger_count"
    guarded = "coalesce(vendorid * 4503599627370496 > 9007199254740992 OR vendorid * 4503599627370496 < -9007199254740992, false)" if guard else "false"
    return f"""WITH e AS (SELECT y.*, tpep_pickup_datetime AS pickup, tpep_dropoff_datetime AS dropoff, CAST({count} AS DOUBLE) AS riders, {guarded} AS guard,
  p.borough AS pb, p.zone_name AS pz, p.location_id IS NOT NULL AS pr, q.borough AS db, q.zone_name AS dz, q.location_id IS NOT NULL AS dr
  FROM yellow_trip y LEFT JOIN zone_lookup p ON pulocationid = p.location_id LEFT JOIN zone_lookup q ON dolocationid = q.location_id),
f AS (SELECT *, pickup IS NULL AS pickup_timestamp_missing, coalesce(dropoff < pickup, false) AS negative_duration, guard AS guarded_promotion_out_of_range,
  coalesce(strftime(pickup, '%Y-%m') <> source_period, false) AS pickup_out_of_declared_period, dropoff IS NULL AS dropoff_timestamp_missing, pulocationid IS NULL OR dolocationid IS NULL AS zone_key_missing,
  (pulocationid IS NOT NULL AND NOT pr) OR (dolocationid IS NOT NULL AND NOT dr) AS zone_key_unknown, {_between("nonexistent")} AS local_time_nonexistent, {_between("ambiguous")} AS local_time_ambiguous,
  sha256(source_file_version_id || chr(10) || '{YELLOW.fingerprint()}' || chr(10) || '{ZONES}') AS derivation FROM e),
g AS (SELECT *, pickup_timestamp_missing OR negative_duration OR guarded_promotion_out_of_range AS held FROM f)
"""


_INCIDENTS = "i AS (" + " UNION ALL ".join(f"SELECT source_file_version_id, source_row_ordinal, derivation, '{r.name}' AS rule, '{r.severity}' AS severity, '{r.action}' AS action FROM g WHERE {r.name}" for r in YELLOW.rules) + ") "
_K = "source_file_version_id, source_row_ordinal"
_SOURCE_OF = {"pickup_datetime": "tpep_pickup_datetime", "dropoff_datetime": "tpep_dropoff_datetime", "vendor_id": "vendorid", "ratecode_id": "ratecodeid", "pickup_location_id": "pulocationid", "dropoff_location_id": "dolocationid", "passenger_count": "riders"}
_HVFHV_SOURCE = {"pickup_location_id": "pulocationid", "dropoff_location_id": "dolocationid"}
_HVFHV_THERE = {"hvfhs_license_num", "dispatching_base_num", "originating_base_num", "request_datetime", "pickup_datetime", "dropoff_datetime", "trip_miles", "trip_time", "base_passenger_fare", "tolls", "tips", "driver_pay", "shared_request_flag", "wav_match_flag"}
_DUCK = {"int64": "BIGINT", "float64": "DOUBLE", "string": "VARCHAR", "timestamp_ntz": "TIMESTAMP"}
_JSON = "to_json({payment_type: payment_type, pickup_location_id: pickup_location_id, source_file_version_id: source_file_version_id, source_row_ordinal: source_row_ordinal, store_and_fwd_flag: store_and_fwd_flag})"
_DECIDE = "CASE WHEN o_orderstatus = 'F' THEN 'rejected' WHEN row_number() OVER (PARTITION BY o_custkey, o_orderstatus <> 'F' ORDER BY o_orderdate DESC, o_orderkey DESC) = 1 THEN 'active' ELSE 'superseded' END AS decision"
_ACTIVE = "SELECT logical_id, arg_max(source_file_version_id, struct_pack(a := published_at_utc, b := source_file_version_id)) AS source_file_version_id FROM artifact_manifest WHERE artifact_kind = 'contracted' GROUP BY logical_id"
_METRICS = "SELECT unnest(['row_count', 'fares', 'fare_cents', 'derivations']) AS metric, unnest([count(*), count(fare_amount), CAST(sum(CAST(round(fare_amount * 100) AS BIGINT)) AS BIGINT), count(DISTINCT derivation_id)]) AS value FROM "
_FOLD = "sha256(string_agg({x}, chr(10) ORDER BY {x}))"
_ORDINAL_KEY = "source_file_version_id || ':' || lpad(CAST(source_row_ordinal AS VARCHAR), 12, '0')"
_VALUES = ["derivation_id", "source_period", "pickup_datetime", "dropoff_datetime", "passenger_count", "trip_distance", "pickup_location_id", "dropoff_location_id", "payment_type", "fare_amount", "tip_amount", "total_amount", "store_and_fwd_flag", "pickup_zone_name"]

ORACLE = {
    "occurrence_scan": "SELECT event_id, row_number() OVER () - 1 AS source_row_ordinal FROM events",
    "dense_ordinals": f"SELECT source_file_version_id, count(*) AS row_count, count(DISTINCT source_row_ordinal) AS distinct_ordinals, min(source_row_ordinal) AS first_ordinal, max(source_row_ordinal) AS last_ordinal, count(*) = count(DISTINCT source_row_ordinal) AND min(source_row_ordinal) = 0 AND max(source_row_ordinal) = count(*) - 1 AS is_dense FROM (SELECT DISTINCT {_K} FROM yellow_trip) GROUP BY source_file_version_id",
    "schema_profile": _DESCRIBE.format(t="yellow_trip"),
    "schema_diff": f"SELECT column_name, CASE WHEN a IS NULL THEN 'added' WHEN b IS NULL THEN 'removed' ELSE 'retyped' END AS change FROM (SELECT column_name, column_type AS a FROM ({_DESCRIBE.format(t='yellow_trip')})) FULL JOIN (SELECT column_name, column_type AS b FROM ({_DESCRIBE.format(t='hvfhv_trip')})) USING (column_name) WHERE a IS DISTINCT FROM b",
    "schema_fingerprint": " UNION ALL ".join(f"SELECT '{t}' AS table_name, sha256('[' || string_agg('[\"' || column_name || '\",\"' || column_type || '\"]', ',' ORDER BY ordinal) || ']') AS fingerprint FROM ({_DESCRIBE.format(t=t)})" for t in ("yellow_trip", "hvfhv_trip")),
    "bounded_sample": "SELECT event_id, user_id, value FROM events ORDER BY event_id LIMIT 1000",
    "version_filter": "SELECT source_file_version_id, source_row_ordinal, fare_amount FROM published_trip WHERE source_file_version_id = (SELECT min(source_file_version_id) FROM published_trip)",
    "distinct_versions": "SELECT DISTINCT source_file_version_id FROM yellow_trip",
    "contract_project": f"SELECT {_K}, " + ", ".join(f"CAST({_HVFHV_SOURCE.get(c.name, c.name) if c.name in _HVFHV_THERE | _HVFHV_SOURCE.keys() else 'NULL'} AS {_DUCK[c.kind]}) AS {c.name}" for c in HVFHV.columns) + " FROM hvfhv_trip",
    "rule_flags": _flag_sql(False) + f"SELECT {_K}, " + ", ".join(r.name for r in YELLOW.rules) + " FROM g",
    "guarded_promotion": _flag_sql(True) + f"SELECT {_K}, riders AS passenger_count FROM g WHERE guard",
    "local_date_hour": f"SELECT {_K}, strftime(tpep_pickup_datetime, '%Y-%m-%d') AS pickup_local_date, CAST(hour(tpep_pickup_datetime) AS INTEGER) AS pickup_local_hour FROM yellow_trip",
    "local_time_flags": _flag_sql(False) + f"SELECT {_K}, local_time_nonexistent AS nonexistent, local_time_ambiguous AS ambiguous FROM g WHERE local_time_nonexistent OR local_time_ambiguous",
    "zone_dimension": "SELECT location_id, coalesce(trim(borough), '') AS borough, coalesce(trim(zone_name), '') AS zone_name, coalesce(trim(service_zone), '') AS service_zone FROM zone_lookup",
    "zone_validation": "SELECT count(*) AS row_count, count(TRY_CAST(location_id AS INTEGER)) - count(DISTINCT TRY_CAST(location_id AS INTEGER)) AS duplicate_ids, count_if(TRY_CAST(location_id AS INTEGER) IS NULL)::BIGINT AS invalid_ids, CAST(0 AS INTEGER) AS missing_columns FROM zone_lookup",
    "zone_join": _flag_sql(False) + f"SELECT {_K}, pb AS pickup_borough, pz AS pickup_zone_name, pr AS pickup_zone_resolved, db AS dropoff_borough, dz AS dropoff_zone_name, dr AS dropoff_zone_resolved FROM g",
    "zone_key_unknown": _flag_sql(False) + f"SELECT {_K}, pulocationid AS pickup_location_id, dolocationid AS dropoff_location_id FROM g WHERE zone_key_unknown",
    "contracted_rows": _flag_sql(True) + f"SELECT {_K}, derivation AS derivation_id, source_period, " + ", ".join(f"{_SOURCE_OF.get(n, n)} AS {n}" for n in YELLOW.names) + ", CAST(hour(pickup) AS INTEGER) AS pickup_local_hour, pr AS pickup_zone_resolved FROM g WHERE NOT held",
    "quarantine_rows": _flag_sql(True) + f"SELECT {_K}, concat_ws(',', CASE WHEN guarded_promotion_out_of_range THEN 'guarded_promotion_out_of_range' END, CASE WHEN negative_duration THEN 'negative_duration' END, CASE WHEN pickup_timestamp_missing THEN 'pickup_timestamp_missing' END) AS reasons FROM g WHERE held",
    "row_incidents": _flag_sql(True) + ", " + _INCIDENTS + "SELECT source_file_version_id, rule, severity, action, count(*) AS incidents FROM i GROUP BY ALL",
    "incident_ids": _flag_sql(False) + ", " + _INCIDENTS + f"SELECT {_K}, rule, sha256(CAST(to_json([source_file_version_id, derivation, CAST(source_row_ordinal AS VARCHAR), rule]) AS VARCHAR)) AS incident_id FROM i",
    "incident_summary": _flag_sql(False) + ", " + _INCIDENTS + "SELECT rule, severity, action, count(*) AS incidents FROM i GROUP BY ALL",
    "row_conservation": _flag_sql(True) + "SELECT source_file_version_id, count(*) AS source_rows, count(CASE WHEN NOT held THEN 1 END) AS published_rows, count(CASE WHEN held THEN 1 END) AS quarantined_rows, true AS conserved FROM g GROUP BY source_file_version_id",
    "derivation_id": f"SELECT source_file_version_id, sha256(source_file_version_id || chr(10) || '{YELLOW.fingerprint()}' || chr(10) || '{ZONES}') AS derivation_id FROM artifact_manifest",
    "quality_metrics_yellow": _metrics_sql("yellow"),
    "quality_metrics_hvfhv": _metrics_sql("hvfhv"),
    "table_totals": f"SELECT count(*) AS row_count, count(DISTINCT ({_K})) AS distinct_rows, count(DISTINCT source_file_version_id) AS files, min(source_period) AS first_period FROM yellow_trip",
    "additive_digest": f"SELECT count(*) AS row_count, CAST(sum(CAST('0x' || substr(sha256(CAST({_JSON} AS VARCHAR)), 1, 15) AS HUGEINT)) AS VARCHAR) AS digest FROM published_trip",
    "sorted_digest": f"WITH h AS (SELECT sha256(CAST({_JSON} AS VARCHAR)) AS h FROM published_trip), c AS (SELECT h, count(*) AS n FROM h GROUP BY h), a AS (SELECT substr(h, 1, 4) AS b, sum(n) AS n, {_FOLD.format(x="h || ':' || n")} AS f FROM c GROUP BY ALL), z AS (SELECT substr(b, 1, 2) AS b, sum(n) AS n, {_FOLD.format(x="b || ':' || f")} AS f FROM a GROUP BY substr(b, 1, 2)) SELECT CAST(sum(n) AS BIGINT) AS row_count, {_FOLD.format(x="b || ':' || f")} AS digest FROM z",
    "key_digest": f"SELECT count(*) AS distinct_keys, CAST(sum(CAST('0x' || substr(sha256(CAST(to_json({{source_file_version_id: source_file_version_id, source_row_ordinal: source_row_ordinal}}) AS VARCHAR)), 1, 15) AS HUGEINT)) AS VARCHAR) AS digest FROM (SELECT DISTINCT {_K} FROM published_trip)",
    "metric_compare": f"SELECT metric, a.value AS left_value, b.value AS right_value, a.value IS NOT DISTINCT FROM b.value AS matches FROM ({_METRICS} published_trip) a FULL JOIN ({_METRICS} rebuilt_trip) b USING (metric)",
    "ordinal_alignment": "WITH s AS (SELECT *, source_file_version_id || ':' || lpad(CAST(source_row_ordinal AS VARCHAR), 12, '0') AS k FROM published_trip), t AS (SELECT *, source_file_version_id || ':' || lpad(CAST(source_row_ordinal AS VARCHAR), 12, '0') AS k FROM rebuilt_trip), j AS (SELECT * FROM (SELECT DISTINCT k, payment_type AS p, store_and_fwd_flag AS f, 1 AS l FROM s) FULL JOIN (SELECT DISTINCT k, payment_type AS p2, store_and_fwd_flag AS f2, 1 AS r FROM t) USING (k)) SELECT count(l) AS left_rows, count(r) AS right_rows, min(CASE WHEN l IS NULL OR r IS NULL OR p IS DISTINCT FROM p2 OR f IS DISTINCT FROM f2 THEN k END) AS first_mismatch, count(l) = count(r) AND count(l) > 0 AND count_if(l IS NULL OR r IS NULL OR p IS DISTINCT FROM p2 OR f IS DISTINCT FROM f2) = 0 AS aligned FROM j",
    "row_alignment": f"WITH s AS (SELECT DISTINCT {_ORDINAL_KEY} AS k, {', '.join(f'{c} AS a_{c}' for c in _VALUES)}, 1 AS l FROM published_trip), t AS (SELECT DISTINCT {_ORDINAL_KEY} AS k, {', '.join(f'{c} AS b_{c}' for c in _VALUES)}, 1 AS r FROM rebuilt_trip), j AS (SELECT *, l IS NULL OR r IS NULL OR {' OR '.join(f'a_{c} IS DISTINCT FROM b_{c}' for c in _VALUES)} AS x FROM s FULL JOIN t USING (k)) SELECT count(l) AS left_rows, count(r) AS right_rows, min(CASE WHEN x THEN k END) AS first_mismatch, count(l) = count(r) AND count(l) > 0 AND count_if(x) = 0 AS aligned FROM j",
    "promotion_profile": "SELECT CASE WHEN column_name = 'passenger_count' AND column_type = 'BIGINT' THEN 'guarded' WHEN column_type IN ('FLOAT', 'INTEGER', 'SMALLINT') THEN 'widening' ELSE 'identity' END AS promotion, count(*) AS columns FROM (DESCRIBE SELECT * REPLACE (CAST(vendorid AS INTEGER) AS vendorid, CAST(payment_type AS SMALLINT) AS payment_type, CAST(trip_distance AS FLOAT) AS trip_distance, CAST(passenger_count AS BIGINT) AS passenger_count) FROM (SELECT * EXCLUDE (source_file_version_id, source_row_ordinal, feed_id, source_period, ingested_at_utc) FROM yellow_trip)) GROUP BY ALL",
    "rule_flags_hvfhv": _flag_sql(False, "hvfhv") + f"SELECT {_K}, " + ", ".join(r.name for r in HVFHV.rules) + " FROM g",
    "contracted_rows_hvfhv": _flag_sql(False, "hvfhv") + f"SELECT {_K}, derivation AS derivation_id, source_period, '{HVFHV.version}' AS contract_version, " + ", ".join(f"CAST({_HVFHV_SOURCE.get(c.name, c.name) if c.name in _HVFHV_THERE | _HVFHV_SOURCE.keys() else 'NULL'} AS {_DUCK[c.kind]}) AS {c.name}" for c in HVFHV.columns) + ", CAST(hour(pickup) AS INTEGER) AS pickup_local_hour, pr AS pickup_zone_resolved FROM g WHERE NOT held",
    "version_selection": f"SELECT o_custkey, o_orderkey, {_DECIDE} FROM orders",
    "ledger_state": "WITH e AS (SELECT event_id, user_id, event_id % 50 AS version, event_id % 3 = 0 AS act FROM events), o AS (SELECT user_id, max(event_id) AS on_id FROM e WHERE act GROUP BY user_id), v AS (SELECT user_id, on_id, on_id % 50 AS version FROM o), f AS (SELECT user_id, version, max(event_id) AS off_id FROM e WHERE NOT act GROUP BY ALL) SELECT u.user_id, CASE WHEN off_id IS NULL OR off_id < on_id THEN v.version END AS active_version FROM (SELECT DISTINCT user_id FROM e) u LEFT JOIN v USING (user_id) LEFT JOIN f ON f.user_id = v.user_id AND f.version = v.version",
    "ledger_reconcile": f"WITH n AS (SELECT o_custkey, o_orderkey, {_DECIDE} FROM orders), o AS (SELECT o_custkey, o_orderkey, {_DECIDE} FROM orders WHERE o_orderdate < TIMESTAMP '1998-01-01') SELECT n.* FROM n LEFT JOIN o USING (o_custkey, o_orderkey) WHERE o.decision IS DISTINCT FROM n.decision",
    "published_view": f"SELECT source_file_version_id, source_row_ordinal, derivation_id, fare_amount FROM published_trip WHERE source_file_version_id IN (SELECT source_file_version_id FROM ({_ACTIVE}))",
    "coverage": "SELECT logical_id, bool_or(artifact_kind = 'contracted') AS covered FROM artifact_manifest WHERE artifact_kind IN ('contracted', 'trip') GROUP BY logical_id",
    "coverage_summary": f"SELECT count(*) AS required, count(p) AS covered, count(*) - count(p) AS missing FROM (SELECT DISTINCT source_file_version_id FROM ({_ACTIVE})) LEFT JOIN (SELECT DISTINCT source_file_version_id, 1 AS p FROM published_trip) USING (source_file_version_id)",
    "inventory_rollup": "SELECT source_service, count(*) AS files, CAST(sum(content_length_bytes) AS BIGINT) AS content_length_bytes FROM artifact_manifest GROUP BY ROLLUP (source_service)",
    "event_counts": "SELECT publication_state, count(*) AS events FROM artifact_manifest GROUP BY publication_state",
    "schema_change_history": """WITH r AS (SELECT source_file_version_id AS f, payload FROM raw_record WHERE json_valid(payload) AND json_type(payload) = 'OBJECT'),
t AS (SELECT f, k, max(CASE json_type(payload, '$."' || k || '"') WHEN 'NULL' THEN 0 WHEN 'BIGINT' THEN 1 WHEN 'UBIGINT' THEN 1 WHEN 'DOUBLE' THEN 2 ELSE 3 END) AS y FROM (SELECT f, payload, unnest(json_keys(payload)) AS k FROM r) GROUP BY f, k),
c AS (SELECT CAST(feed_id AS VARCHAR) AS feed, source_period, k AS field_name, max(y) AS y FROM t JOIN (SELECT DISTINCT source_file_version_id AS f, feed_id, source_period FROM artifact_manifest WHERE artifact_kind = 'raw' AND source_period IS NOT NULL) USING (f) GROUP BY ALL),
p AS (SELECT feed, source_period, lead(source_period) OVER (PARTITION BY feed ORDER BY source_period) AS nxt FROM (SELECT DISTINCT feed, source_period FROM c)),
b AS (SELECT c.feed, nxt AS source_period, field_name, y AS o FROM c JOIN p USING (feed, source_period) WHERE nxt IS NOT NULL), a AS (SELECT c.feed, c.source_period, field_name, y AS n FROM c SEMI JOIN (SELECT feed, nxt AS source_period FROM p WHERE nxt IS NOT NULL) q USING (feed, source_period))
SELECT feed, source_period, field_name, CASE WHEN o IS NULL THEN 'added' WHEN n IS NULL THEN 'removed' ELSE 'retyped' END AS change FROM b FULL JOIN a USING (feed, source_period, field_name) WHERE o IS DISTINCT FROM n""",
    "fare_day_yellow": "SELECT strftime(tpep_pickup_datetime, '%Y-%m-%d') AS local_date, count(*) AS trips, " + ", ".join(f"count({c}) AS {c}_rows, CAST(sum(CAST(round({c} * 100) AS BIGINT)) AS BIGINT) AS {c}_cents" for c in YELLOW.components) + " FROM yellow_trip GROUP BY ALL",
    "dimensional_zones": "SELECT DISTINCT pulocationid FROM hvfhv_trip",
    "dimensional_services": "SELECT DISTINCT hvfhs_license_num FROM hvfhv_trip",
    "dimensional_versions": "SELECT DISTINCT source_file_version_id, feed_id, source_period FROM hvfhv_trip",
    "zone_hour_demand": "SELECT pulocationid AS zone_id, strftime(tpep_pickup_datetime, '%Y-%m-%d') AS local_date, CAST(hour(tpep_pickup_datetime) AS INTEGER) AS local_hour, count(*) AS trips FROM yellow_trip WHERE tpep_pickup_datetime IS NOT NULL GROUP BY ALL",
    "fare_day": "SELECT strftime(pickup_datetime, '%Y-%m-%d') AS local_date, count(*) AS trips, " + ", ".join(f"count({c}) AS {c}_rows, CAST(sum(CAST(round({c} * 100) AS BIGINT)) AS BIGINT) AS {c}_cents" for c in _HVFHV_COMPONENTS) + " FROM hvfhv_trip GROUP BY ALL",
    "dimensional_dates": "SELECT DISTINCT CAST(strftime(pickup_datetime, '%Y%m%d') AS INTEGER) AS date_key, strftime(pickup_datetime, '%Y-%m-%d') AS local_date, CAST(year(pickup_datetime) AS INTEGER) AS year, CAST(month(pickup_datetime) AS INTEGER) AS month, CAST(dayofweek(pickup_datetime) + 1 AS INTEGER) AS weekday FROM hvfhv_trip WHERE pickup_datetime IS NOT NULL",
}
