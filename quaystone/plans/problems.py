"""The queries of the data-quality problems, and SQL that says the same where SQL can."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quaystone.operators import drift, instants, profile, references, spikes, tablediff
from quaystone.runtime import table

ROW = ["source_file_version_id", "source_row_ordinal"]
FILE = "source_file_version_id"


def _files(spark: SparkSession, d: str, kind: str) -> DataFrame:
    return table(spark, d, "artifact_manifest").where(F.col("artifact_kind") == kind).select(FILE, "feed_id", "published_at_utc").distinct()


# 1 ------------------------------------------------------------------------------------------------------------------


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    """Added, removed, renamed and retyped fields of each raw file against the file before."""
    return drift.changes(table(spark, d, "raw_record"), _files(spark, d, "raw"), FILE, "payload", ["feed_id"], "published_at_utc")


def _one_table(spark: SparkSession, d: str) -> DataFrame:
    return drift.consistent_table(table(spark, d, "raw_record"), _files(spark, d, "raw"), FILE, "payload", ROW, ["feed_id"], "published_at_utc")


def p1_table(spark: SparkSession, d: str) -> DataFrame:
    """All raw payloads as one consistent table; fields beyond its columns as JSON text."""
    return _one_table(spark, d).withColumn("more_fields", F.when(F.size("more_fields") > 0, F.to_json("more_fields")))


def p1_cells(spark: SparkSession, d: str) -> DataFrame:
    """The consistent table value by value."""
    return drift.cells(_one_table(spark, d), ROW)


def p1_rejected(spark: SparkSession, d: str) -> DataFrame:
    """Raw rows whose payload is no JSON object, and why."""
    return drift.rejected(table(spark, d, "raw_record"), ROW, "payload")


def p1_scripts(spark: SparkSession, d: str) -> DataFrame:
    """The edit script between each raw file's schema and the one before it."""
    raw = table(spark, d, "raw_record")
    known = _files(spark, d, "raw").join(drift.file_schemas(raw, FILE, "payload"), FILE)
    return drift.edit_scripts(drift.chained(known, ["feed_id"], "published_at_utc", FILE, ["schema"]), FILE)


# 2 ------------------------------------------------------------------------------------------------------------------


RANGES, PATTERNS = {"pulocationid": (1, 265), "fare_amount": (-500, 1500)}, {"source_period": profile.MONTH}


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    """Columns of yellow files that break their form or depart from the file before."""
    return profile.findings(
        table(spark, d, "yellow_trip"), _files(spark, d, "trip"), ROW, FILE, ["feed_id"], "published_at_utc",
        ranges=RANGES, patterns=PATTERNS, nulls=["fare_amount", "pulocationid", "source_period"],
        distincts=["fare_amount", "pulocationid"], medians=["fare_amount"], shares=["pulocationid"],
    )


def p2_profile(spark: SparkSession, d: str) -> DataFrame:
    """Rates, ranges, violations, quartiles and Kolmogorov-Smirnov distances of every column of the yellow files but the row's key; times in microseconds."""
    trips = table(spark, d, "yellow_trip")
    texts = [c for c, t in trips.dtypes if t == "string" and c not in ROW]
    return profile.profile(
        trips, _files(spark, d, "trip"), ROW, FILE, ["feed_id"], "published_at_utc", [c for c in trips.columns if c not in (*ROW, *texts)], texts,
        ranges=RANGES, patterns=PATTERNS,
    )


# 3 ------------------------------------------------------------------------------------------------------------------


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    """The instants that the meters' text times name."""
    return instants.stamp_instants(table(spark, d, "meter_stamp"), "stamp_id", [FILE], ["tpep_pickup_datetime", "tpep_dropoff_datetime"], "clock_zone")


# 5 ------------------------------------------------------------------------------------------------------------------


def _references(spark: SparkSession, d: str) -> DataFrame:
    sides = []
    for name in ("yellow_trip", "hvfhv_trip"):
        refs = references.reference_deltas(table(spark, d, name), [*ROW, "source_period"], ["pulocationid", "dolocationid"], "ingested_at_utc")
        sides.append(refs.select(F.lit(name).alias("table_name"), "*"))
    return sides[0].unionByName(sides[1])


def _zone_deltas(spark: SparkSession, d: str) -> DataFrame:
    return references.existence_deltas(table(spark, d, "zone_lookup"), "location_id", "added_at_utc", "retired_at_utc")


def _orphans(spark: SparkSession, d: str) -> DataFrame:
    found = references.orphans(_references(spark, d), references.segments(_zone_deltas(spark, d)))
    return found.select("table_name", *ROW, "source_period", "field_name", "reason", "delta")


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    """Zone references that the lookup did not hold when the row was taken in."""
    return _orphans(spark, d).select("table_name", *ROW, "field_name", "reason").distinct()


def p5_report(spark: SparkSession, d: str) -> DataFrame:
    """Signed counts of the references that meet no existence, per table, period, field and reason."""
    return _orphans(spark, d).distinct().groupBy("table_name", "source_period", "field_name", "reason").agg(F.sum("delta").alias("orphans")).where("orphans > 0")


def p5_keys(spark: SparkSession, d: str) -> DataFrame:
    """Zones that are referred to and do not exist now, with their signed reference counts."""
    single = _references(spark, d).select("table_name", *ROW, "field_name", "ref_key", "delta").distinct()
    refs = references.apply_deltas(None, single, ["table_name", "ref_key"], "refs")
    alive = references.apply_deltas(None, _zone_deltas(spark, d), ["ref_key"], "existing")
    return references.orphan_keys(refs, alive, ["table_name", "ref_key"])


# 6 ------------------------------------------------------------------------------------------------------------------


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    """Rows on one side only and differing cells of the published and the rebuilt trips."""
    return tablediff.table_diff(table(spark, d, "published_trip"), table(spark, d, "rebuilt_trip"), [*ROW, "derivation_id"], "only_published", "only_rebuilt")


def p6_cells(spark: SparkSession, d: str) -> DataFrame:
    """As p6_found, with the values of either side as text."""
    return tablediff.table_diff(table(spark, d, "published_trip"), table(spark, d, "rebuilt_trip"), [*ROW, "derivation_id"], "only_published", "only_rebuilt", values=True)


# 7 ------------------------------------------------------------------------------------------------------------------

METER = spikes.Model(fields=("trip_distance", "fare_amount", "total_amount", "passenger_count"), leveled=("trip_distance", "fare_amount", "total_amount"), runs=("trip_distance", "fare_amount", "total_amount"))
MILES_PER_HOUR, RIDERS = 200, 9


def _readings(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "yellow_trip")
    us = lambda c: F.unix_micros(F.col(c).cast("timestamp"))
    lasted = us("tpep_dropoff_datetime") - us("tpep_pickup_datetime")
    fast = (lasted > 0) & (F.col("trip_distance") * 3_600_000_000 > lasted * MILES_PER_HOUR)
    bounds = {"trip_distance": (F.col("trip_distance") < 0) | F.coalesce(fast, F.lit(False)), "passenger_count": (F.col("passenger_count") < 0) | (F.col("passenger_count") > RIDERS)}
    return spikes.implausible(rows, METER, "feed_id", ROW, bounds)


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    """Impossible, stuck and outlying readings, field by field: what the sources' models flag, held to the exact rules."""
    return _readings(spark, d).where("exact").select(*ROW, "field_name")


def p7_flags(spark: SparkSession, d: str) -> DataFrame:
    """All readings that the sources' models flag, with their state and the probability that they are not normal."""
    return _readings(spark, d)


QUERIES = {f.__name__: f for f in (p1_found, p1_table, p1_cells, p1_rejected, p1_scripts, p2_found, p2_profile, p3_found, p5_found, p5_report, p5_keys, p6_found, p6_cells, p7_found, p7_flags)}

_CHAIN = """chain AS (SELECT source_file_version_id AS f, lag(source_file_version_id) OVER (PARTITION BY feed_id ORDER BY published_at_utc, source_file_version_id) AS p
  FROM (SELECT DISTINCT source_file_version_id, feed_id, published_at_utc FROM artifact_manifest WHERE artifact_kind = 'trip' AND source_file_version_id IN (SELECT source_file_version_id FROM yellow_trip)))"""
# The spellings of the test tables, for the SQL alone; the operator finds them by itself.
_SPELLINGS = {
    "airport_fee": "airport-fee airportFee airport_fee Airport_fee arprt_fee fee_airport",
    "cbd_congestion_fee": "cbd_congestion_fee CBD_Congestion_Fee cbdCongestionFee cbd_cong_fee congestion_fee_cbd",
    "passenger_count": "count_passenger Passenger+Count passenger_cnt PassengerCount passenger_count psgr_count",
    "trip_distance": "distance_trip trip_dist trip_distance TripDistance",
    "payment_type": "payment_type Payment_Type pmt_type type_payment",
    "vendor_id": "id_vendor Vendor+ID VendorID vendorId vendor_id VENDORID vndr_id",
}
_WORDS = {"fee_airport": "fee_airport", "arprt_fee": "arprt_fee", "cbd_cong_fee": "cbd_cong_fee", "congestion_fee_cbd": "congestion_fee_cbd", "count_passenger": "count_passenger", "passenger_cnt": "passenger_cnt", "psgr_count": "psgr_count",
          "distance_trip": "distance_trip", "trip_dist": "trip_dist", "pmt_type": "pmt_type", "type_payment": "type_payment", "id_vendor": "id_vendor", "vndr_id": "vndr_id", "VENDORID": "vendorid"}
_NAMES = ", ".join([f"('{s.replace('+', ' ')}', '{n}', '{_WORDS.get(s, n)}')" for n, group in _SPELLINGS.items() for s in group.split()] + ["('PULocationID', 'PULocationID', 'pu_location_id')", "('DOLocationID', 'DOLocationID', 'do_location_id')"])
_DRIFT = f"""WITH names(k, n, w) AS (VALUES {_NAMES}),
r AS (SELECT source_file_version_id AS f, payload FROM raw_record WHERE json_valid(payload) AND json_type(payload) = 'OBJECT'),
t AS (SELECT f, k, max(CASE json_type(payload, '$."' || k || '"') WHEN 'NULL' THEN 0 WHEN 'BIGINT' THEN 1 WHEN 'UBIGINT' THEN 1 WHEN 'DOUBLE' THEN 2 ELSE 3 END) AS y FROM (SELECT f, payload, unnest(json_keys(payload)) AS k FROM r) GROUP BY f, k),
c AS (SELECT f, t.k, y, coalesce(n, t.k) AS n FROM t LEFT JOIN names ON t.k = names.k),
m AS (SELECT DISTINCT source_file_version_id AS f, feed_id, published_at_utc AS pub FROM artifact_manifest WHERE artifact_kind = 'raw' AND source_file_version_id IN (SELECT source_file_version_id FROM raw_record)),
chain AS (SELECT *, lag(f) OVER (PARTITION BY feed_id ORDER BY pub, f) AS p FROM m),
b AS (SELECT chain.f, k, n, y FROM chain JOIN c ON c.f = chain.p),
came AS (SELECT c.f, c.k, c.n FROM c JOIN chain ON c.f = chain.f AND p IS NOT NULL ANTI JOIN b ON b.f = c.f AND b.k = c.k),
gone AS (SELECT b.f, b.k, b.n FROM b ANTI JOIN c ON c.f = b.f AND c.k = b.k)
"""
_ORPHANS = """WITH refs AS (
  SELECT DISTINCT 'yellow_trip' AS table_name, source_file_version_id, source_row_ordinal, source_period, ingested_at_utc, pulocationid, dolocationid FROM yellow_trip
  UNION ALL SELECT DISTINCT 'hvfhv_trip', source_file_version_id, source_row_ordinal, source_period, ingested_at_utc, pulocationid, dolocationid FROM hvfhv_trip
), long AS (
  SELECT table_name, source_file_version_id, source_row_ordinal, source_period, ingested_at_utc, 'pulocationid' AS field_name, pulocationid AS k FROM refs
  UNION ALL SELECT table_name, source_file_version_id, source_row_ordinal, source_period, ingested_at_utc, 'dolocationid', dolocationid FROM refs
), found AS (
  SELECT table_name, source_file_version_id, source_row_ordinal, source_period, field_name,
    CASE WHEN location_id IS NULL THEN 'missing' WHEN ingested_at_utc < added_at_utc THEN 'later' WHEN ingested_at_utc >= retired_at_utc THEN 'deleted' END AS reason
  FROM long LEFT JOIN zone_lookup ON k = location_id WHERE k IS NOT NULL
)
"""
_CELLS = ["source_period", "pickup_datetime", "dropoff_datetime", "passenger_count", "trip_distance", "pickup_location_id", "dropoff_location_id", "payment_type", "fare_amount", "tip_amount", "total_amount", "store_and_fwd_flag", "pickup_zone_name"]
_KEYS = "source_file_version_id, source_row_ordinal, derivation_id"
_BOTH = "WITH a AS (SELECT DISTINCT * FROM published_trip), b AS (SELECT DISTINCT * FROM rebuilt_trip), j AS (SELECT a.*, " + ", ".join(f"b.{c} AS b_{c}" for c in _CELLS) + f" FROM a JOIN b USING ({_KEYS})) "


def _cell_text(c: str) -> str:
    """A value as Arrow writes it: numbers without an empty fraction and exponents without leading zeros, times to the microsecond."""
    if c.endswith("_datetime"):
        return f"strftime({c}, '%Y-%m-%d %H:%M:%S.%f')"
    if c.endswith(("_zone_name", "_flag", "_period")):
        return c
    return f"regexp_replace(regexp_replace(CAST({c} AS VARCHAR), '[.]0$', ''), 'e([+-])0', 'e\\1')"


_TRIP_COLUMNS = ["feed_id", "source_period", "ingested_at_utc", "vendorid", "tpep_pickup_datetime", "tpep_dropoff_datetime", "passenger_count", "trip_distance", "ratecodeid", "store_and_fwd_flag", "pulocationid", "dolocationid", "payment_type", "fare_amount", "extra", "mta_tax", "tip_amount", "tolls_amount", "improvement_surcharge", "total_amount", "congestion_surcharge", "airport_fee", "cbd_congestion_fee"]
_TRIP_TEXTS = ("source_period", "store_and_fwd_flag")


def _as_number(c: str) -> str:
    return "NULL::DOUBLE" if c in _TRIP_TEXTS else f"CAST(epoch_us({c}) AS DOUBLE)" if c.endswith(("_utc", "_datetime")) else f"CAST({c} AS DOUBLE)"


def _as_text(c: str) -> str:
    return c if c in _TRIP_TEXTS else "NULL::VARCHAR"


_LEVELED = ("trip_distance", "fare_amount", "total_amount")
# One pattern of five parts (date, hour, minute, second, fraction), half of the day and zone; the dates are taken apart by form.
_STAMP = r"""^(?:[A-Za-z]{3,9},? )?(?:([0-9]{4}-[0-9]{1,2}-[0-9]{1,2}|[0-9]{4}/[0-9]{1,2}/[0-9]{1,2}|[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}|[0-9]{1,2}[.][0-9]{1,2}[.][0-9]{4}|[0-9]{1,2}[ -][A-Za-z]{3,9}[.]?,?[ -][0-9]{4}|[A-Za-z]{3,9}[.]? [0-9]{1,2},? [0-9]{4})(?:[Tt]|,?\s+)([0-9]{1,2}):([0-9]{2})(?::([0-9]{2})(?:[.,]([0-9]+))?)?|([0-9]{8})[T ]([0-9]{2})([0-9]{2})(?:([0-9]{2})(?:[.,]([0-9]+))?)?)(?:\s*([AaPp])[.]?[Mm][.]?)?(?:\s*(?:([A-Za-z]{1,5})|([+-][0-9]{2}:?(?:[0-9]{2})?)|\[?([A-Za-z]+/[A-Za-z_/+0-9-]+)\]?))?$"""
_ZONES_SQL = ", ".join(f"('{k}', {v})" for k, v in instants.ABBREVIATIONS.items())
_LOCAL = "timezone(z, make_timestamptz({x}))"
ORACLE = {
    "p3_found": f"""WITH s AS (SELECT DISTINCT stamp_id, source_file_version_id AS f, clock_zone, field_name, regexp_replace(v, '^\\s+|\\s+$', '', 'g') AS v FROM (
  SELECT *, 'tpep_pickup_datetime' AS field_name, tpep_pickup_datetime AS v FROM meter_stamp UNION ALL SELECT *, 'tpep_dropoff_datetime', tpep_dropoff_datetime FROM meter_stamp) WHERE v IS NOT NULL),
g AS (SELECT *, regexp_extract(v, '{_STAMP}', ['da', 'h1', 'i1', 's1', 'f1', 'cd', 'h2', 'i2', 's2', 'f2', 'ap', 'zn', 'zo', 'zi']) AS r FROM s WHERE regexp_matches(v, '{_STAMP}')),
a AS (SELECT stamp_id, f, clock_zone, field_name, r.da || CASE WHEN r.cd <> '' THEN r.cd[1:4] || '-' || r.cd[5:6] || '-' || r.cd[7:8] ELSE '' END AS da, CAST(r.h1 || r.h2 AS INT) AS h, CAST(r.i1 || r.i2 AS INT) AS i, coalesce(TRY_CAST(r.s1 || r.s2 AS INT), 0) AS s,
  CAST(rpad((r.f1 || r.f2)[1:6], 6, '0') AS BIGINT) AS us, lower(r.ap) AS ap, upper(r.zn) AS zn, r.zo AS zo, r.zi AS zi FROM g),
n AS (SELECT *, [CAST(x AS INT) FOR x IN regexp_extract_all(da, '[0-9]+')] AS p, regexp_matches(da, '^[0-9]+/[0-9]+/[0-9]{{4}}$') AS slash, list_position(['jan', 'feb', 'mar', 'apr', 'may', 'jun', 'jul', 'aug', 'sep', 'oct', 'nov', 'dec'], lower(regexp_extract(da, '[A-Za-z]{{3}}'))) AS mo FROM a),
o AS (SELECT f, count_if(p[1] > 12 AND p[1] <= 31 AND p[2] BETWEEN 1 AND 12) * 2 > count_if((p[1] > 12 AND p[1] <= 31 AND p[2] BETWEEN 1 AND 12) OR (p[2] > 12 AND p[2] <= 31 AND p[1] BETWEEN 1 AND 12)) AS dmy FROM n WHERE slash AND (p[1] BETWEEN 13 AND 31 AND p[2] BETWEEN 1 AND 12 OR p[2] BETWEEN 13 AND 31 AND p[1] BETWEEN 1 AND 12) GROUP BY f),
d AS (SELECT n.*, CASE WHEN slash THEN p[3] WHEN regexp_matches(da, '^[0-9]{{4}}') THEN p[1] ELSE p[-1] END AS y,
  CASE WHEN slash THEN CASE WHEN dmy THEN p[2] WHEN NOT dmy THEN p[1] WHEN p[1] = p[2] THEN p[1] END WHEN regexp_matches(da, '[A-Za-z]') THEN mo WHEN regexp_matches(da, '^[0-9]{{4}}') THEN p[2] ELSE p[2] END AS m,
  CASE WHEN slash THEN CASE WHEN dmy THEN p[1] WHEN NOT dmy THEN p[2] WHEN p[1] = p[2] THEN p[1] END WHEN regexp_matches(da, '^[0-9]{{4}}') THEN p[3] ELSE p[1] END AS d,
  CASE WHEN ap = '' THEN h WHEN h BETWEEN 1 AND 12 THEN h % 12 + CASE ap WHEN 'p' THEN 12 ELSE 0 END END AS hh FROM n LEFT JOIN o USING (f)),
l AS (SELECT stamp_id, field_name, clock_zone, zn, zo, zi, epoch_us(CAST(t AS TIMESTAMP)) + CAST((hh * 60 + i) * 60 + s AS BIGINT) * 1000000 + us AS u FROM (SELECT *, TRY_CAST(format('{{:04d}}-{{:02d}}-{{:02d}}', y, m, d) AS DATE) AS t FROM d WHERE m IS NOT NULL AND d IS NOT NULL) WHERE t IS NOT NULL AND hh BETWEEN 0 AND 23 AND i < 60 AND s < 60),
fixed AS (SELECT stamp_id, field_name, u - CAST(1000000 AS BIGINT) * CASE WHEN zo <> '' THEN (CAST(regexp_extract(zo, '([0-9]{{2}})', 1) AS INT) * 3600 + coalesce(TRY_CAST(regexp_extract(zo, '[0-9]{{2}}:?([0-9]{{2}})$', 1) AS INT), 0) * 60) * CASE zo[1] WHEN '-' THEN -1 ELSE 1 END ELSE sec END AS u FROM l LEFT JOIN (VALUES {_ZONES_SQL}) q(k, sec) ON zn = k WHERE zn <> '' OR zo <> ''),
c AS (SELECT stamp_id, field_name, u, z FROM (SELECT *, CASE WHEN zi <> '' THEN zi ELSE coalesce(nullif(trim(clock_zone), ''), 'America/New_York') END AS z FROM l WHERE zn = '' AND zo = '') SEMI JOIN (SELECT name AS z FROM pg_timezone_names()) USING (z)),
w AS (SELECT stamp_id, field_name, u, z, epoch_us(timezone(z, make_timestamp(u))) + unnest([-3600000000, -1800000000, 0, 1800000000, 3600000000]) AS x FROM c),
civil AS (SELECT stamp_id, field_name, max(x) AS u FROM w WHERE {_LOCAL.format(x="x")} = make_timestamp(u) GROUP BY stamp_id, field_name, u HAVING count(*) = 1),
bare AS (SELECT stamp_id, field_name, CASE WHEN length(v) <= 11 THEN TRY_CAST(v AS BIGINT) * 1000000 WHEN length(v) <= 14 THEN TRY_CAST(v AS BIGINT) * 1000 WHEN length(v) <= 16 THEN TRY_CAST(v AS BIGINT) ELSE TRY_CAST(v AS BIGINT) // 1000 END AS u FROM s WHERE regexp_matches(v, '^[0-9]{{9,19}}$'))
SELECT DISTINCT stamp_id, field_name, u AS utc_micros FROM (FROM fixed UNION ALL FROM civil UNION ALL FROM bare) WHERE u IS NOT NULL""",
    "p1_found": _DRIFT + """SELECT f AS source_file_version_id, k AS field_name, CASE WHEN EXISTS (SELECT 1 FROM gone WHERE gone.f = came.f AND gone.n = came.n) THEN 'renamed' ELSE 'added' END AS change_kind FROM came
UNION ALL SELECT f, k, 'removed' FROM gone WHERE NOT EXISTS (SELECT 1 FROM came WHERE gone.f = came.f AND gone.n = came.n)
UNION ALL SELECT f, k, 'retyped' FROM (SELECT f, k, y, lag(y) OVER (PARTITION BY feed_id, n ORDER BY pub, f) AS before FROM c JOIN m USING (f) WHERE y > 0) WHERE y <> before""",
    "p1_scripts": _DRIFT + """, ops AS (
  SELECT came.f, 'rename' AS op, gone.k AS path, came.k AS to_path, NULL AS a, NULL AS b, 0.5 AS w FROM came JOIN gone USING (f, n)
  UNION ALL SELECT f, 'add', k, NULL, NULL, NULL, 1.0 FROM came WHERE NOT EXISTS (SELECT 1 FROM gone WHERE gone.f = came.f AND gone.n = came.n)
  UNION ALL SELECT f, 'delete', k, NULL, NULL, NULL, 1.0 FROM gone WHERE NOT EXISTS (SELECT 1 FROM came WHERE gone.f = came.f AND gone.n = came.n)
  UNION ALL SELECT c.f, 'retype', c.k, NULL, list_extract(['null', 'integer', 'decimal', 'text'], b.y + 1), list_extract(['null', 'integer', 'decimal', 'text'], c.y + 1), 0.25 FROM c JOIN b ON b.f = c.f AND b.n = c.n AND b.y <> c.y)
SELECT f AS source_file_version_id, op, path, to_path, a AS from_kind, b AS to_kind, CAST(sum(w) OVER (PARTITION BY f) AS DOUBLE) AS cost FROM ops""",
    "p1_cells": _DRIFT + """, u AS (SELECT DISTINCT source_file_version_id AS f, source_row_ordinal AS o, payload FROM raw_record WHERE json_valid(payload) AND json_type(payload) = 'OBJECT'),
v AS (SELECT f, o, k, json_type(payload, '$."' || k || '"') AS kind, payload ->> ('$."' || k || '"') AS x FROM (SELECT *, unnest(json_keys(payload)) AS k FROM u)),
label AS (SELECT n, max(y) AS y, arg_min(w, struct_pack(a := -length(w), b := -files, c := w)) AS field_name FROM (SELECT c.k, n, max(y) AS y, count(DISTINCT f) AS files, coalesce(max(names.w), c.k) AS w FROM c LEFT JOIN names USING (k, n) GROUP BY c.k, n) GROUP BY n)
SELECT DISTINCT f AS source_file_version_id, o AS source_row_ordinal, field_name, CASE WHEN label.y = 2 THEN CAST(CAST(x AS DOUBLE) AS VARCHAR) WHEN label.y = 3 AND kind = 'DOUBLE' THEN regexp_replace(CAST(CAST(x AS DOUBLE) AS VARCHAR), '[.]0$', '') ELSE x END AS value
FROM v LEFT JOIN names USING (k) JOIN label ON label.n = coalesce(names.n, v.k) WHERE kind <> 'NULL'""",
    "p1_rejected": "SELECT DISTINCT source_file_version_id, source_row_ordinal, CASE WHEN payload IS NULL THEN 'null' WHEN NOT json_valid(payload) THEN 'no_json' ELSE 'no_object' END AS reason FROM raw_record WHERE payload IS NULL OR NOT json_valid(payload) OR json_type(payload) <> 'OBJECT'",
    "p2_found": f"""WITH y AS (SELECT DISTINCT source_file_version_id AS f, source_row_ordinal, fare_amount, pulocationid, source_period FROM yellow_trip), {_CHAIN},
s AS (SELECT f, count(*) AS n, count(fare_amount) AS nf, count(pulocationid) AS np, count(source_period) AS ns, count(DISTINCT fare_amount) AS df, count(DISTINCT pulocationid) AS dp, median(fare_amount) AS mf,
  count_if(fare_amount < -500 OR fare_amount > 1500) AS xf, count_if(pulocationid < 1 OR pulocationid > 265) AS xp, count_if(NOT regexp_full_match(source_period, '[0-9]{{4}}-(0[1-9]|1[0-2])')) AS xs FROM y GROUP BY f),
z AS (SELECT f, pulocationid AS k, count(*) / sum(count(*)) OVER (PARTITION BY f) AS w FROM y WHERE pulocationid IS NOT NULL GROUP BY f, pulocationid),
tv AS (SELECT f, sum(abs(w)) / 2 AS tv FROM (SELECT f, k, sum(w) AS w FROM (SELECT f, k, w FROM z UNION ALL SELECT chain.f, k, -w FROM z JOIN chain ON chain.p = z.f) GROUP BY f, k) GROUP BY f),
j AS (SELECT s.*, b.n AS bn, b.nf AS bnf, b.np AS bnp, b.ns AS bns, b.df AS bdf, b.dp AS bdp, b.mf AS bmf, tv FROM s JOIN chain USING (f) LEFT JOIN s b ON chain.p = b.f LEFT JOIN tv USING (f))
SELECT f AS source_file_version_id, column_name, finding FROM (
  SELECT f, 'fare_amount' AS column_name, 'value_range' AS finding FROM j WHERE nf > 0 AND xf * 20 >= nf
  UNION ALL SELECT f, 'pulocationid', 'value_range' FROM j WHERE np > 0 AND xp * 20 >= np
  UNION ALL SELECT f, 'source_period', 'pattern' FROM j WHERE ns > 0 AND xs * 20 >= ns
  UNION ALL SELECT f, 'fare_amount', 'null_rate' FROM j WHERE 10 * ((n - nf) * bn - (bn - bnf) * n) >= n * bn
  UNION ALL SELECT f, 'pulocationid', 'null_rate' FROM j WHERE 10 * ((n - np) * bn - (bn - bnp) * n) >= n * bn
  UNION ALL SELECT f, 'source_period', 'null_rate' FROM j WHERE 10 * ((n - ns) * bn - (bn - bns) * n) >= n * bn
  UNION ALL SELECT f, 'fare_amount', 'distinct_count' FROM j WHERE bdf > 0 AND df * 10 <= bdf
  UNION ALL SELECT f, 'pulocationid', 'distinct_count' FROM j WHERE bdp > 0 AND dp * 10 <= bdp
  UNION ALL SELECT f, 'fare_amount', 'distribution' FROM j WHERE bmf > 0 AND (mf >= bmf * 1.5 OR mf * 1.5 <= bmf)
  UNION ALL SELECT f, 'pulocationid', 'distribution' FROM j WHERE np > 0 AND bnp > 0 AND tv >= 0.8 - 1e-12)""",
    "p2_profile": f"""WITH y AS (SELECT DISTINCT * FROM yellow_trip), {_CHAIN},
l AS ({" UNION ALL ".join(f"SELECT source_file_version_id AS f, '{c}' AS column_name, {_as_number(c)} AS v, {_as_text(c)} AS t FROM y" for c in _TRIP_COLUMNS)}),
s AS (SELECT f, column_name, count(*) AS rows, count(*) - count(v) - count(t) AS nulls, CASE column_name WHEN 'pulocationid' THEN count_if(v < 1 OR v > 265) WHEN 'fare_amount' THEN count_if(v < -500 OR v > 1500) END AS outside,
  CASE column_name WHEN 'source_period' THEN count_if(NOT regexp_full_match(t, '[0-9]{{4}}-(0[1-9]|1[0-2])')) END AS broken, count(DISTINCT v) + count(DISTINCT t) AS distinct_values, min(v) AS low, max(v) AS high, min(t) AS first_text, max(t) AS last_text,
  quantile_cont(v, 0.25) AS q25, quantile_cont(v, 0.5) AS median, quantile_cont(v, 0.75) AS q75 FROM l GROUP BY f, column_name),
n AS (SELECT f, column_name, v, t, count(*) / sum(count(*)) OVER (PARTITION BY f, column_name) AS w FROM l WHERE v IS NOT NULL OR t IS NOT NULL GROUP BY f, column_name, v, t),
d AS (SELECT f, column_name, v, t, sum(w) AS w FROM (SELECT n.f, column_name, v, t, w FROM n JOIN chain ON n.f = chain.f AND p IS NOT NULL UNION ALL SELECT chain.f, column_name, v, t, -w FROM n JOIN chain ON chain.p = n.f) GROUP BY f, column_name, v, t),
k AS (SELECT f, column_name, max(abs(c)) AS ks FROM (SELECT f, column_name, sum(w) OVER (PARTITION BY f, column_name ORDER BY v) AS c FROM d WHERE v IS NOT NULL) GROUP BY f, column_name),
z AS (SELECT d.f, column_name, sum(abs(w)) / 2 AS tv FROM d JOIN chain ON d.f = chain.f WHERE t IS NOT NULL AND (d.f, column_name) IN (SELECT (f, column_name) FROM n) AND (p, column_name) IN (SELECT (f, column_name) FROM n) GROUP BY d.f, column_name)
SELECT s.f AS source_file_version_id, column_name, rows, nulls, outside, broken, distinct_values, low, high, first_text, last_text, q25, median, q75, round(ks, 9) AS ks, round(tv, 9) AS text_distance FROM s LEFT JOIN k USING (f, column_name) LEFT JOIN z USING (f, column_name)""",
    "p5_found": _ORPHANS + "SELECT DISTINCT table_name, source_file_version_id, source_row_ordinal, field_name, reason FROM found WHERE reason IS NOT NULL",
    "p5_report": _ORPHANS + "SELECT table_name, source_period, field_name, reason, count(*) AS orphans FROM found WHERE reason IS NOT NULL GROUP BY ALL",
    "p5_keys": _ORPHANS + "SELECT table_name, k AS ref_key, count(*) AS refs FROM long WHERE k NOT IN (SELECT location_id FROM zone_lookup WHERE retired_at_utc IS NULL) GROUP BY ALL",
    "p6_found": _BOTH + f"SELECT {_KEYS}, 'only_published' AS difference FROM a ANTI JOIN b USING ({_KEYS}) UNION ALL SELECT {_KEYS}, 'only_rebuilt' FROM b ANTI JOIN a USING ({_KEYS}) "
    + " ".join(f"UNION ALL SELECT {_KEYS}, '{c}' FROM j WHERE {c} IS DISTINCT FROM b_{c}" for c in _CELLS),
    "p6_cells": _BOTH + f"SELECT {_KEYS}, 'only_published' AS difference, NULL AS left_value, NULL AS right_value FROM a ANTI JOIN b USING ({_KEYS}) UNION ALL SELECT {_KEYS}, 'only_rebuilt', NULL, NULL FROM b ANTI JOIN a USING ({_KEYS}) "
    + " ".join(f"UNION ALL SELECT {_KEYS}, '{c}', {_cell_text(c)}, {_cell_text('b_' + c)} FROM j WHERE {c} IS DISTINCT FROM b_{c}" for c in _CELLS),
    "p7_found": "WITH y AS (SELECT DISTINCT source_file_version_id, source_row_ordinal, feed_id, tpep_pickup_datetime AS a, tpep_dropoff_datetime AS b, trip_distance, fare_amount, total_amount, passenger_count FROM yellow_trip), "
    + "m AS (SELECT feed_id, " + ", ".join(f"median({f}) AS m_{f}" for f in _LEVELED) + " FROM y GROUP BY feed_id), found AS ("
    + " UNION ALL ".join(f"SELECT source_file_version_id, source_row_ordinal, '{f}' AS field_name FROM y JOIN m USING (feed_id) WHERE abs({f}) > 20 * m_{f}" for f in _LEVELED)
    + " ".join(f" UNION ALL SELECT source_file_version_id, source_row_ordinal, '{f}' FROM (SELECT *, count(*) OVER (PARTITION BY source_file_version_id, {f}, g) AS run FROM (SELECT source_file_version_id, source_row_ordinal, {f}, source_row_ordinal - row_number() OVER (PARTITION BY source_file_version_id, {f} ORDER BY source_row_ordinal) AS g FROM y WHERE {f} IS NOT NULL)) WHERE run >= 12" for f in _LEVELED)
    + " UNION ALL SELECT source_file_version_id, source_row_ordinal, 'trip_distance' FROM y WHERE trip_distance < 0 OR (b > a AND trip_distance * 3600000000 > 200 * (epoch_us(b) - epoch_us(a)))"
    + " UNION ALL SELECT source_file_version_id, source_row_ordinal, 'passenger_count' FROM y WHERE passenger_count < 0 OR passenger_count > 9) SELECT DISTINCT * FROM found",
}
