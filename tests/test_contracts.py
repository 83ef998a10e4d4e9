from datetime import datetime

import pytest
from pyspark.sql import types as T

from quaystone.contracts import resolve, types
from quaystone.contracts.model import CONTRACTS, HVFHV, RULES, YELLOW
from quaystone.contracts.versions import Boundary, Candidate, Catalog, Conflict, Marker, decide, derivation_id, install
from quaystone.functions.civiltime import describe, transitions
from quaystone.sources import inventory, scan

MATRIX = {
    "int32": "IWxWxxxx", "int64": "NIxGxxxx", "float32": "NxIWxxxx", "float64": "NNNIxxxx", "string": "xxxxIxxx", "boolean": "xxxxxIxx", "timestamp_ntz": "xxxxxxIN", "date": "xxxxxxWI",
}
LETTER = {"I": "identity", "W": "widening", "G": "guarded", "N": "narrowing", "x": "incompatible"}


def test_promotion_matrix():
    for source, row in MATRIX.items():
        for target, letter in zip(types.SQL_NAMES, row, strict=True):
            want = LETTER[letter]
            if (source, target) == ("float32", "int64"):
                want = "narrowing"
            assert types.classify(source, target) == want, (source, target)
            assert types.classify("untyped_null", target) == "untyped_null_cast"
    with pytest.raises(KeyError):
        types.classify("int32", "untyped_null")
    assert types.guard_bound("int64", "float64") == 2**53 and types.guard_bound("int32", "float64") is None


def test_types_by_class_and_name():
    assert [types.of_spark(t) for t in (T.ByteType(), T.ShortType(), T.LongType(), T.TimestampNTZType(), T.NullType())] == ["int32", "int32", "int64", "timestamp_ntz", "untyped_null"]
    assert types.of_spark(T.DecimalType(10, 2)).startswith(types.UNSUPPORTED)
    assert types.of_name('"NULL"') == "untyped_null" and types.of_name("HUGEINT").startswith(types.UNSUPPORTED)


def test_contracts():
    assert [len(c.columns) for c in CONTRACTS.values()] == [20, 25]
    assert [r.name for r in RULES if r.action == "quarantine"] == ["pickup_timestamp_missing", "negative_duration", "guarded_promotion_out_of_range"]
    for c in CONTRACTS.values():
        aliases = [a for x in c.columns for a in x.document()["aliases"]]
        assert len(aliases) == len(set(aliases))
    assert [len(c.components) for c in CONTRACTS.values()] == [10, 9] and set(YELLOW.components) & set(HVFHV.components) == {"congestion_surcharge", "airport_fee", "cbd_congestion_fee"}
    assert all(c.column(x).kind == "float64" for c in CONTRACTS.values() for x in c.components)
    assert [c.document()["contract_version"] for c in CONTRACTS.values()] == ["yellow/v1", "hvfhv/v1"] and YELLOW.document()["grain"] == HVFHV.document()["grain"]
    assert YELLOW.fingerprint() != HVFHV.fingerprint() and len(YELLOW.fingerprint()) == 64
    with pytest.raises(KeyError):
        YELLOW.column("nothing")


def _source(**other):
    kinds = {"tpep_pickup_datetime": "timestamp_ntz", "tpep_dropoff_datetime": "timestamp_ntz", "PULocationID": "int64", "DOLocationID": "int64", "fare_amount": "float64", "total_amount": "float64"} | other
    return tuple(resolve.Source(n, k) for n, k in kinds.items())


def test_resolution():
    ok = resolve.resolve(YELLOW, _source(passenger_count="int64", note="string", Airport_fee="untyped_null"))
    assert ok.accepted and ok.unmapped == ("note",) and [m.name for m in ok.guarded] == ["passenger_count"]
    assert ok.mapping("airport_fee").status == "untyped_null_source" and ok.mapping("extra").status == "absent_in_source"
    bad = resolve.resolve(YELLOW, _source(airport_fee="float64", Airport_fee="float64", total_amount="string", payment_type="float64", extra="unsupported:decimal(10,2)", tip_amount="int64")[:2] + _source(airport_fee="float64", Airport_fee="float64", total_amount="string", payment_type="float64", extra="unsupported:decimal(10,2)", tip_amount="int64")[3:])
    assert {v.rule for v in bad.violations} == {"missing_required_column", "ambiguous_canonical_column", "incompatible_type_drift", "narrowing_type_drift", "unsupported_source_type", "guarded_promotion_not_allowed"}
    assert resolve.resolve(YELLOW, _source(strange="unsupported:array<int>")).accepted
    assert len(resolve.unreadable(YELLOW, "x" * 999).violations[0].detail) == 300
    assert ok.fingerprint() == resolve.resolve(YELLOW, _source(passenger_count="int64", note="string", Airport_fee="untyped_null")).fingerprint()
    recorded = resolve.of_records([{"name": "a", "duckdb_type": "INTEGER", "logical_type": "NullType()"}, {"name": "b", "duckdb_type": "DOUBLE"}])
    assert [c.kind for c in recorded] == ["untyped_null", "float64"]


def test_civil_time():
    at = lambda *a: datetime(*a)
    spring, autumn = transitions(2024, 3, "America/New_York"), transitions(2024, 11, "America/New_York")
    assert [(i.start, i.end, i.kind) for i in spring] == [(at(2024, 3, 10, 2), at(2024, 3, 10, 3), "nonexistent")]
    assert [(i.start, i.end, i.kind) for i in autumn] == [(at(2024, 11, 3, 1), at(2024, 11, 3, 2), "ambiguous")]
    assert [(i.start, i.end) for i in transitions(2025, 3, "America/New_York")] == [(at(2025, 3, 9, 2), at(2025, 3, 9, 3))]
    assert [(i.start, i.end) for i in transitions(2024, 10, "Australia/Lord_Howe")] == [(at(2024, 10, 6, 2), at(2024, 10, 6, 2, 30))]
    assert not any(transitions(y, m, "America/New_York") for y, m in ((2023, 7), (2024, 1), (2024, 2), (2024, 4), (2024, 10), (2024, 12), (2025, 1)))
    with pytest.raises(LookupError):
        transitions(2024, 3, "Mars/Olympus_Mons")
    assert describe(2024, 3, "Mars/Olympus_Mons")["available"] is False


def test_decide_is_independent_of_order():
    cs = [Candidate("a", "v1", "2024-01"), Candidate("a", "v2", "2024-02"), Candidate("a", "v3", "2024-03", ("bad:x",)), Candidate("b", "w", "2024-01", ("bad:x",))]
    one, two = decide(cs), decide(cs[::-1])
    assert one == two
    assert {d["version_id"]: d["state"] for d in one} == {"v1": "superseded", "v2": "active", "v3": "rejected", "w": "rejected"}
    assert decide([Candidate("a", "x", "t"), Candidate("a", "y", "t")])[0]["version_id"] == "y"


def _marker(logical="a", version="v", state="active", fp="f", zone="z", at="2024-01", violations=()):
    return Marker(logical, "yellow", "2024-01", version, at, state, fp, zone, derivation_id(version, fp, zone), violations)


def test_catalog(tmp_path):
    c = Catalog(tmp_path)
    assert c.publish(_marker()) == "installed" and c.publish(_marker()) == "unchanged"
    with pytest.raises(Conflict):
        c.publish(_marker(at="2025-01"))
    with pytest.raises(ValueError):
        c.publish(_marker(state="superseded"))
    with pytest.raises(ValueError):
        c.publish(_marker(state="rejected", violations=("unreadable_source_schema:*",)))
    assert c.visible()["trip"] == set()
    first = Boundary("z", {"yellow": "f"})
    assert c.settle(first) == "installed" and c.settle(first) == "unchanged"
    assert c.visible()["trip"] == {_marker().derivation_id}
    c.publish(_marker(version="w", at="2024-02"))
    assert c.visible()["trip"] == {_marker(version="w").derivation_id}
    c.publish(_marker(logical="b", version="r", state="rejected", violations=("x:y",)))
    assert len(c.visible()["incident"]) == 2
    moved = first.merged("z2", {})
    assert first.changed(moved) == ["zone_lookup"] and c.missing(moved, {"a"}) == {"b"}
    with pytest.raises(Conflict):
        c.settle(moved)
    assert first.changed(first.merged("z", {"hvfhv": "g"})) == []


def test_ledger(tmp_path):
    c = Catalog(tmp_path)
    d1 = decide([Candidate("a", "v1", "1")])
    assert len(c.reconcile(d1, "r", "t")) == 1 and c.reconcile(d1, "r2", "t2") == []
    c.reconcile(decide([Candidate("a", "v1", "1"), Candidate("a", "v2", "2")]), "r", "t")
    assert c.active() == {"a": "v2"}
    c.reconcile(d1, "r", "t")  # v1 is back: recorded again
    assert c.active() == {"a": "v1"}


def test_install_conflict(tmp_path):
    p = tmp_path / "x.json"
    assert [install(p, {"a": 1}), install(p, {"a": 1}), install(p, {"a": 2}, overwrite=True)] == ["installed", "unchanged", "installed"]
    with pytest.raises(Conflict):
        install(p, {"a": 3})


def test_inventory():
    assert inventory.parse_period("2024-01") == (2024, 1) and inventory.parse_artifact("hvfhv:2024-02") == ("hvfhv", "2024-02")
    for bad in ("2024-13", "2024-1", "24-01", "2024-01\n"):
        with pytest.raises(ValueError):
            inventory.parse_period(bad)
    assert len(inventory.annual_files(2019)) == 23 and inventory.annual_files(2024)[0]["url"].endswith("yellow_tripdata_2024-01.parquet")
    with pytest.raises(ValueError):
        inventory.source_file("hvfhv", 2019, 1)
    schemas = {"2024-01": [("a", "int"), ("b", "int")], "2024-02": [("a", "bigint"), ("b", "int")], "2024-03": [("a", "bigint"), ("c", "int")]}
    got = inventory.first_and_last(schemas)
    assert got["consecutive"]["2024-01..2024-02"]["retyped"] == [("a", "int", "bigint")] and got["first_to_last"]["removed"] == ["b"]
    assert scan.schema_fingerprint([("a", "x"), ("b", "x")]) != scan.schema_fingerprint([("b", "x"), ("a", "x")])
    assert len(inventory.unique_schemas(schemas)) == 3 and inventory.meets_target(5, 4)["meets_target"]
    assert inventory.events_by_state([{"state": "a"}, {"state": "a"}]) == {"a": 2}
