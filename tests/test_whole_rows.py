"""What speaks for whole rows sees every column."""

import hashlib
import json
from collections import Counter
from datetime import UTC, datetime, timedelta

import pytest

from quaystone.plans import contract_queries, problems, row_digests

SCHEMA = "source_file_version_id string, source_row_ordinal bigint, derivation_id string, source_period string, pickup_datetime timestamp_ntz, dropoff_datetime timestamp_ntz, passenger_count double, trip_distance double, pickup_location_id bigint, dropoff_location_id bigint, payment_type bigint, fare_amount double, tip_amount double, total_amount double, store_and_fwd_flag string, pickup_zone_name string"
COLUMNS = [c.split()[0] for c in SCHEMA.split(", ")]
AT = datetime(2024, 3, 5, 10)
ROWS = [("f", i, "d", "2024-03", AT, AT + timedelta(minutes=i), 1.0, 2.5, 7, 8, 1, 10.0 + i, 1.5, None if i == 2 else 12.0, "N", "Elm") for i in range(4)]


def changed(column: str) -> list[tuple]:
    """ROWS with another value of one column in row 2."""
    k = COLUMNS.index(column)
    old = ROWS[2][k]
    new = 0.25 if old is None else old + timedelta(microseconds=1) if isinstance(old, datetime) else old + "x" if isinstance(old, str) else old + 1
    return [r[:k] + (new,) + r[k + 1 :] if r[1] == 2 else r for r in ROWS]


def saved(spark, folder, **tables) -> str:
    for name, rows in tables.items():
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


@pytest.mark.parametrize("column", COLUMNS[2:])
def test_alignment_sees_every_column(spark, tmp_path, column):
    got = contract_queries.row_alignment(spark, saved(spark, tmp_path, published_trip=ROWS, rebuilt_trip=changed(column))).first()
    assert (got["left_rows"], got["right_rows"], got["first_mismatch"], got["aligned"]) == (4, 4, "f:000000000002", False)


def test_alignment_of_equal_copies(spark, tmp_path):
    got = contract_queries.row_alignment(spark, saved(spark, tmp_path, published_trip=ROWS, rebuilt_trip=[*ROWS[::-1], ROWS[0]])).first()
    assert got["aligned"] and got["first_mismatch"] is None


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def digests(rows: list[tuple]) -> list[tuple]:
    """Both digests in plain Python."""
    plain = lambda x: round((x - datetime(1970, 1, 1)) / timedelta(microseconds=1)) if isinstance(x, datetime) else x
    hashes = [sha(json.dumps({c: plain(x) for c, x in sorted(zip(COLUMNS, r, strict=True))}, separators=(",", ":"), ensure_ascii=False)) for r in rows]
    folds = {h: str(n) for h, n in Counter(hashes).items()}
    for width in (4, 2, 0):
        parts: dict[str, list[str]] = {}
        for k, v in folds.items():
            parts.setdefault(k[:width], []).append(f"{k}:{v}")
        folds = {k: sha("\n".join(sorted(v))) for k, v in parts.items()}
    return [(len(rows), str(sum(int(h[:15], 16) for h in hashes))), (len(rows), folds[""])]


def test_row_digests_see_every_column(spark, tmp_path):
    seen = set()
    for name, rows in {"": ROWS, "twice": [*ROWS, ROWS[0]], **{c: changed(c) for c in COLUMNS}}.items():
        d = saved(spark, tmp_path / f"at_{name}", published_trip=rows)
        got = [tuple(f(spark, d).first()) for f in row_digests.QUERIES.values()]
        assert got == digests(rows), name
        seen.update(got)
    assert len(seen) == 2 * (len(COLUMNS) + 2)


YELLOW = "source_file_version_id string, source_row_ordinal bigint, feed_id bigint, source_period string, ingested_at_utc timestamp, tpep_pickup_datetime timestamp_ntz, tpep_dropoff_datetime timestamp_ntz, pulocationid bigint, fare_amount double"


def test_profile_of_every_column(spark, tmp_path):
    taken = datetime(2024, 4, 1, tzinfo=UTC)
    at = [AT + timedelta(microseconds=i) for i in range(4)]
    rows = [(f, i, 9, "2024-3" if i == 3 else "2024-03", taken, None if i == 0 else at[i] + timedelta(days=k), at[i], 999 if i < 2 else 5, None if i == 2 else 10.0 - 600 * i) for k, f in enumerate("ab") for i in range(4)]
    spark.createDataFrame([*rows, rows[0]], YELLOW).coalesce(1).write.parquet(f"{tmp_path}/yellow_trip.parquet")
    files = [(f, 9, "trip", taken + timedelta(days=k)) for k, f in enumerate("ab")]
    spark.createDataFrame(files, "source_file_version_id string, feed_id bigint, artifact_kind string, published_at_utc timestamp").coalesce(1).write.parquet(f"{tmp_path}/artifact_manifest.parquet")
    got = {(r["source_file_version_id"], r["column_name"]): r for r in problems.p2_profile(spark, str(tmp_path)).collect()}
    assert {c for _, c in got} == {c.split()[0] for c in YELLOW.split(", ")[2:]}
    micros = lambda t: int((t - datetime(1970, 1, 1)).total_seconds()) * 1_000_000 + t.microsecond
    up = got["a", "tpep_pickup_datetime"]
    assert (up["rows"], up["nulls"], up["distinct_values"], up["low"], up["median"], up["high"], up["ks"]) == (4, 1, 3, micros(at[1]), micros(at[2]), micros(at[3]), None)
    assert got["b", "tpep_pickup_datetime"]["ks"] == 1 and got["b", "tpep_dropoff_datetime"]["ks"] == 0
    assert got["a", "feed_id"]["low"] == 9 and got["a", "ingested_at_utc"]["low"] == micros(taken.replace(tzinfo=None))
    assert got["a", "pulocationid"]["outside"] == 2 and got["a", "fare_amount"]["outside"] == 2 and got["a", "source_period"]["broken"] == 1
    assert up["outside"] is None and up["broken"] is None
