"""The data-quality operators against plain Python, and their defined results for odd input."""

import json
from datetime import UTC, datetime

import numpy as np
import pyarrow.dataset as ds
import pytest
from pyspark.sql import functions as F

from quaystone.operators import curves, drift, instants, profile, ranks, references, spikes, tablediff
from quaystone.operators.schema_tree import edit_script, parse_schema, same_field, shortens, words
from quaystone.plans import problems
from tests import brute

SF = "/root/testdata/sf0.001"
FILE, ORD = "source_file_version_id", "source_row_ordinal"


def rows(name, *columns):
    t = ds.dataset(f"{SF}/{name}.parquet").to_table(columns=list(columns))
    return list(zip(*[c.to_pylist() for c in t.columns], strict=True))


def found(df):
    return {tuple(r) for r in df.collect()}


# 1


def test_p1_equals_brute_force(spark):
    files = [(f, feed, at) for f, feed, at, kind in rows("artifact_manifest", FILE, "feed_id", "published_at_utc", "artifact_kind") if kind == "raw"]
    want = brute.drift(rows("raw_record", FILE, "payload"), files)
    assert found(problems.p1_found(spark, SF)) == want and want


def test_spellings():
    for a, group in brute.CANON.items():
        for s in group:
            assert same_field(a, s) and same_field(s, a), (a, s)
    for a in brute.CANON:
        for b in brute.CANON:
            assert a == b or not same_field(a, b)
    for a, b in (("tip_amount", "trip_amount"), ("fare_amount", "airport_fee"), ("extra", "ehail_fee"), ("PULocationID", "DOLocationID"), ("congestion_surcharge", "cbd_congestion_fee"), ("VENDORID", "payment_id")):
        assert not same_field(a, b)
    for a, b in (("pickup_date", "pickup_datetime"), ("ct", "city"), ("st", "state"), ("created", "created_at")):
        assert not same_field(a, b)
    assert same_field("vendor_id", "vndrid") and same_field("VENDORID", "vndr_id") and words("airportFeeUSD") == ("airport", "fee", "usd") and shortens("psgr", "passenger") and not shortens("fee", "fare")


def test_edit_script_of_nested_schemas():
    old = parse_schema("OBJECT<a: BIGINT, b: OBJECT<`x y`: STRING, z: DOUBLE>, trip_dist: DECIMAL(3,1), gone: VOID>")
    new = parse_schema("OBJECT<a: DECIMAL(3,1), b: OBJECT<xY: STRING>, tripDistance: DECIMAL(3,1), z: DOUBLE, l: ARRAY<OBJECT<k: BIGINT>>>")
    cost, ops = edit_script(old, new)
    dotted = lambda p: p and ".".join(p)
    assert {(o["op"], dotted(o["path"]), dotted(o.get("to_path"))) for o in ops} == {("rename", "b.x y", "b.xY"), ("rename", "trip_dist", "tripDistance"), ("move", "b.z", "z"), ("delete", "gone", None), ("add", "l", None), ("add", "l.[]", None), ("add", "l.[].k", None), ("retype", "a", None)}
    assert cost == 0.5 + 0.5 + 1.5 + 1 + 3 + 0.25 and edit_script(old, old) == (0.0, [])
    # leaves move out of a subtree that goes, and a whole subtree moves to another parent
    assert edit_script(parse_schema("OBJECT<a: OBJECT<x: BIGINT, y: BIGINT, z: BIGINT>>"), parse_schema("OBJECT<b: OBJECT<x: BIGINT, y: BIGINT, z: BIGINT>>"))[0] == 6.5
    cost, ops = edit_script(parse_schema("OBJECT<a: OBJECT<p: OBJECT<x: BIGINT, y: BIGINT>>, c: OBJECT<k: BIGINT>>"), parse_schema("OBJECT<a: OBJECT<q: BIGINT>, c: OBJECT<k: BIGINT, p: OBJECT<x: BIGINT, y: DOUBLE>>>"))
    assert cost == 1.5 + 1 + 0.25 and [o["op"] for o in ops] == ["move", "add", "retype"]
    assert edit_script(parse_schema(None), parse_schema("OBJECT<>")) == (0.0, [])


def _raw(spark, payloads):
    files = spark.createDataFrame([(f, 1, datetime(2024, 1, i + 1)) for i, f in enumerate(payloads)], f"{FILE} string, feed_id bigint, published_at_utc timestamp")
    recs = spark.createDataFrame([(f, i, p) for f, ps in payloads.items() for i, p in enumerate(ps)] or [("x", 0, None)], f"{FILE} string, {ORD} bigint, payload string")
    return recs if payloads else recs.limit(0), files


def test_drift_over_gaps_and_odd_payloads(spark):
    j = json.dumps
    recs, files = _raw(spark, {
        "f1": [j({"airport_fee": 1, "n": 1}), None, "{cut", "[1]", j({"airport_fee": 2, "n": 1})],
        "f2": [j({"airportFee": None, "n": 1.5}), j({"airportFee": None, "n": 1.5})],
        "f3": [j({"n": None})],
        "f4": [j({"arprt_fee": "x", "n": 2})],
        "f5": ["{cut"],
    })
    want = {("f2", "airportFee", "renamed"), ("f2", "n", "retyped"), ("f3", "airportFee", "removed"), ("f4", "arprt_fee", "added"), ("f4", "arprt_fee", "retyped"), ("f4", "n", "retyped"), ("f5", "arprt_fee", "removed"), ("f5", "n", "removed")}
    assert found(drift.changes(recs.withColumn("PAYLOAD_", F.lit(1)), files, FILE, "payload", ["feed_id"], "published_at_utc")) == want
    t = drift.consistent_table(recs, files, FILE, "payload", [FILE, ORD], ["feed_id"], "published_at_utc")
    assert dict(t.dtypes) == {FILE: "string", ORD: "bigint", "airport_fee": "string", "n": "double", "more_fields": "map<string,string>"} and t.count() == 6
    assert found(drift.rejected(recs, [FILE, ORD], "payload")) == {("f1", 1, "null"), ("f1", 2, "no_json"), ("f1", 3, "no_object"), ("f5", 0, "no_json")}
    none = recs.limit(0)
    assert found(drift.changes(none, files, FILE, "payload", ["feed_id"], "published_at_utc")) == set()
    assert drift.consistent_table(none, files, FILE, "payload", [FILE, ORD], ["feed_id"], "published_at_utc").count() == 0


def _table(spark, payloads):
    recs, files = _raw(spark, {f: [json.dumps(p) for p in ps] for f, ps in payloads.items()})
    t = drift.consistent_table(recs, files, FILE, "payload", [FILE, ORD], ["feed_id"], "published_at_utc")
    return t, {(r[FILE], r[ORD]): {k: v for k, v in r.asDict().items() if k not in (FILE, ORD) and v not in (None, {})} for r in t.collect()}


def test_one_table_loses_nothing(spark, monkeypatch):
    big = 12345678901234567890123
    payloads = {
        "f1": [{"pickup_date": "2024-01-01", "pickup_datetime": "2024-01-01 10:00", "a.b": 1, "from_station_to": 1, "to_station_from": 2}],
        "f2": [{"a": {"b": 2, "c d": {"e": [1, {"x": 2}]}}, "big": big, "huge": 10**45, "ok": True}, {"big": 5, "huge": 1.5}],
        "f3": [{"a": {"b": 2.5, "cD": {"e": None}}, "q\"o\\te": "t", "big": 7.25}],
    }
    t, got = _table(spark, payloads)
    assert got["f1", 0] == {"pickup_date": "2024-01-01", "pickup_datetime": "2024-01-01 10:00", "a_b": 1, "from_station_to": 1, "to_station_from": 2}
    assert got["f2", 0]["a_b_"] == 2 and json.loads(got["f2", 0]["a_c_d_e"]) == [1, {"x": 2}] and got["f3", 0]["a_b_"] == 2.5
    assert got["f2", 0]["big"] == big and got["f2", 1]["big"] == 5 and float(got["f3", 0]["big"]) == 7.25 and got["f2", 0]["huge"] == str(10**45) and got["f2", 0]["ok"] == "true" and got["f3", 0]["q_o_te"] == "t"
    monkeypatch.setattr(drift, "MOST_COLUMNS", 2)
    _, few = _table(spark, payloads)
    for row, cells in few.items():
        assert len(cells.get("more_fields", {})) + len(cells) - ("more_fields" in cells) == len(got[row]), row


def test_classes_by_blocks_are_the_same(spark, monkeypatch):
    names = [n for g in brute.CANON.values() for n in g] + ["vndrid", "created", "created_at", "pickup_date", "pickup_datetime", "x"]
    paths = spark.createDataFrame([([n], f"s{i}") for i, n in enumerate(names)] + [(["arprt_fee"], "s0")], "path array<string>, shape string")
    links = paths.limit(0).select("path", F.col("path").alias("to_path"))
    sets = []
    for most in (2000, 1):
        monkeypatch.setattr(drift, "ONE_BLOCK", most)
        of = {}
        for r in drift.field_classes(paths, links).collect():
            of.setdefault(tuple(r["field"]), set()).add(r["path"][0])
        sets.append(sorted(map(sorted, of.values())))
    assert sets[0] == sets[1] and ["arprt_fee"] in sets[0]  # it stands in one schema with another spelling


def test_no_block_parts_what_one_block_joins(spark, monkeypatch):
    rng = np.random.default_rng(11)
    shorter = {"pickup": "pckp", "vendor": "vndr", "amount": "amt", "airport": "arprt", "street": "str"}

    def name():
        ws = [shorter.get(w, w) if rng.random() < 0.35 else w for w in rng.choice([*shorter, "date", "time", "id", "fee", "state"], rng.integers(1, 4))]
        return ["_".join(ws), ws[0] + "".join(w.title() for w in ws[1:]), "".join(ws), ws[0] + "_" + "".join(ws[1:])][rng.integers(4)]

    pool = sorted({tuple(name() for _ in range(rng.integers(1, 3))) for _ in range(90)})
    some = [pool[i] for i in rng.integers(0, len(pool), 12)]
    odd = [("dropoffDateTime",), ("dropoff_datetime",), ("datetime_dropoff",), ("old",), ("new",), ("",), ("", "k"), ("##",), ("größe", "k")]
    paths = spark.createDataFrame([(list(p), f"s{rng.integers(20)}") for p in pool] + [(list(p), f"t{i}") for i, p in enumerate(odd)], "path array<string>, shape string")
    links = spark.createDataFrame([(["old"], ["new"]), (["old"], ["nowhere"])] + [(list(p), list(q)) for p, q in zip(some[::2], some[1::2], strict=True)], "path array<string>, to_path array<string>")
    got = []
    for most in (2000, 40, 1):
        monkeypatch.setattr(drift, "ONE_BLOCK", most)
        got.append({tuple(r["path"]): tuple(r["field"]) for r in drift.field_classes(paths, links).collect()})
    assert got[0] == got[1] == got[2] and len(got[0]) == len(pool) + len(odd)
    assert got[2]["datetime_dropoff",] == got[2]["dropoff_datetime",] == got[2]["dropoffDateTime",] and got[2]["old",] == got[2]["new",]


# 2


def test_profile_exactness(spark):
    rng = np.random.default_rng(1)
    data = [("a" if i % 3 else "b", float(rng.integers(0, 40)) / 4) for i in range(3000)] + [("c", 1.0)] * 50
    df = spark.createDataFrame(data, "g string, v double")
    counts = ranks.value_counts(df, ["g"], "v")
    for ranges in (1, 7):
        got = {r["g"]: r for r in ranks.quantiles(ranks.ranked(counts, ["g"], "v", ranges), ["g"], "v", {"q": 0.25, "m": 0.5}).collect()}
        for g in "abc":
            v = np.array([x for k, x in data if k == g])
            assert got[g]["m"] == np.median(v) and got[g]["q"] == np.quantile(v, 0.25) and got[g]["distincts"] == len(set(v)) and got[g]["total"] == len(v)


def test_ks(spark):
    rng = np.random.default_rng(2)
    a, b = np.round(rng.normal(0, 1, 400), 1), np.round(rng.normal(0.7, 1, 300), 1)
    df = spark.createDataFrame([("a", "x", float(v)) for v in a] + [("b", "x", float(v)) for v in b], "f string, c string, v double")
    r = ranks.ranked(ranks.value_counts(df, ["f", "c"], "v"), ["f", "c"], "v", 5)
    link = spark.createDataFrame([("b", "x", "a")], "f string, c string, previous_f string")
    got = ranks.ks_distances(r, ["f", "c"], "v", link, ["f"]).collect()
    at = np.unique(np.r_[a, b])
    want = max(abs((a <= x).mean() - (b <= x).mean()) for x in at)
    assert len(got) == 1 and abs(got[0]["ks"] - want) < 1e-9


def test_curves_do_not_depend_on_pieces(spark, monkeypatch):
    rng = np.random.default_rng(12)
    data = [(int(g), float(v)) for g, v in zip(rng.integers(1, 4, 4000), np.round(rng.normal(0, 5, 4000), 1), strict=True)]
    data += [(1, None), (2, float("nan")), (2, float("nan")), (1, -0.0), (4, None)] + [(3, 2.5)] * 500
    df = spark.createDataFrame(data, "g int, v double").repartition(5)
    before = spark.createDataFrame([(2, 1), (3, 2), (4, 3)], "load int, _before int")
    shares = {"q": 0.1, "m": 0.5, "z": 0.97}
    got = []
    for per_range, at_once in ((10**9, 10**9), (300, 250)):
        monkeypatch.setattr(curves, "ROWS_PER_RANGE", per_range)
        monkeypatch.setattr(curves, "ROWS_AT_ONCE", at_once)
        parts = curves.pieces(df, "g", ["v"], {0: (-5.0, 5.0)}, curves.splitters(df, ["v"]))
        assert parts.where("_range > 0").count() == 0 or per_range == 300
        rows = {r["load"]: r.asDict() for r in curves.curves(parts, before, shares).collect()}
        got.append({k: {n: None if x is None else "nan" if x != x else round(x, 9) for n, x in r.items()} for k, r in rows.items()})
    assert got[0] == got[1] and set(got[0]) == {1, 2, 3, 4} and (got[0][4]["distinct_values"], got[0][4]["m"], got[0][4]["ks"]) == (0, None, 1)
    of = lambda g: np.sort([v for k, v in data if k == g and v is not None])
    for g in (1, 3):
        assert [got[0][g][n] for n in shares] == [round(float(np.quantile(of(g), q)), 9) for q in shares.values()] and got[0][g]["distinct_values"] == len(set(of(g).tolist()))
    at = np.unique(np.r_[of(1), of(2)[:-2]])
    assert got[0][1]["ks"] is None and got[0][2]["high"] == "nan"
    assert got[0][2]["ks"] == round(max(abs((of(2)[:-2] <= x).sum() / len(of(2)) - (of(1) <= x).mean()) for x in at), 9)
    assert curves.curves(curves.pieces(df.limit(0), "g", ["v"], {}, [[]]), before, shares).count() == 0


def _findings(spark, trips):
    df = spark.createDataFrame([(f, i, fare, zone, period) for f, rs in trips.items() for i, (fare, zone, period) in enumerate(rs)], f"{FILE} string, {ORD} bigint, fare_amount double, pulocationid bigint, source_period string")
    files = spark.createDataFrame([(f, 1, datetime(2024, 1, k + 1)) for k, f in enumerate(trips)], f"{FILE} string, feed_id bigint, published_at_utc timestamp")
    df = df.union(df.limit(3))  # delivered twice
    return found(profile.findings(df, files, [FILE, ORD], FILE, ["feed_id"], "published_at_utc", {"pulocationid": (1, 265), "fare_amount": (-500, 1500)}, {"source_period": profile.MONTH}, ["fare_amount", "pulocationid", "source_period"], ["fare_amount", "pulocationid"], ["fare_amount"], ["pulocationid"]))


def test_findings_at_the_limits(spark):
    base = [(float(i % 40) + 1, i % 20 + 1, "2024-01") for i in range(40)]
    got = _findings(spark, {
        "1": base,
        "2": [(None if i < 4 else f, z, p) for i, (f, z, p) in enumerate(base)],
        "3": [(f if i > 3 else f, 999 if i < 2 else z, "2024-13" if i < 2 else p) for i, (f, z, p) in enumerate(base)],
        "4": [(f * 2, z, "2024-01\n" if i < 1 else p) for i, (f, z, p) in enumerate(base)],
        "5": [(5.0, 200, None) for _ in base],
        "6": [(None, None, None) for _ in base],
    })
    assert got == {
        ("2", "fare_amount", "null_rate"), ("3", "pulocationid", "value_range"), ("3", "source_period", "pattern"), ("4", "fare_amount", "distribution"),
        ("5", "fare_amount", "distribution"), ("5", "fare_amount", "distinct_count"), ("5", "pulocationid", "distinct_count"), ("5", "pulocationid", "distribution"), ("5", "source_period", "null_rate"),
        ("6", "fare_amount", "null_rate"), ("6", "pulocationid", "null_rate"), ("6", "fare_amount", "distinct_count"), ("6", "pulocationid", "distinct_count"),
    }


# 3


def test_p3_equals_brute_force(spark):
    stamps, order, want = set(rows("meter_stamp", "stamp_id", FILE, "clock_zone", "tpep_pickup_datetime", "tpep_dropoff_datetime")), {}, set()
    import re

    for _, f, _, *values in stamps:
        for v in values:
            if m := re.match(r"\s*(\d\d?)/(\d\d?)/\d{4}", v or ""):
                a, b = int(m[1]), int(m[2])
                if (a > 12) != (b > 12):
                    order[f] = a > 12
    for i, f, z, up, off in stamps:
        for n, v in (("tpep_pickup_datetime", up), ("tpep_dropoff_datetime", off)):
            if (u := brute.instant(v, z, order.get(f))) is not None:
                want.add((i, n, u))
    assert found(problems.p3_found(spark, SF)) == want


def test_odd_times(spark):
    us = lambda *a: int(datetime(*a, tzinfo=UTC).timestamp() * 1_000_000)
    cases = [
        ("2024-03-10 02:30:00", None, None), ("2024-11-03 01:30:00", None, None), ("2024-11-03 01:30:00 EST", None, us(2024, 11, 3, 6, 30)), ("2024-11-03T01:30:00-04:00", None, us(2024, 11, 3, 5, 30)),
        ("2024-01-01 00:00", "", us(2024, 1, 1, 5)), ("2024-01-01 00:00", "America/Chicago", us(2024, 1, 1, 6)), ("2024-01-01 00:00", "No/Where", None), ("2024-02-30 10:00", None, None), ("2023-02-29T00:00:00Z", None, None),
        ("2024-02-29T00:00:00.1234567Z", None, us(2024, 2, 29) + 123456), (" 12:00:00", None, None), ("01/02/2024 12:00:00 am", None, us(2024, 1, 2, 5)), ("13/13/2024 01:00", None, None), ("05.04.2024 10:00", None, us(2024, 4, 5, 14)),
        ("1700000000", None, 1_700_000_000_000_000), ("1700000000123", None, 1_700_000_000_123_000), ("1700000000123456789", None, 1_700_000_000_123_456), ("9999999999999999999", None, None), ("Sep 3, 2024 1:05:09 PM", None, us(2024, 9, 3, 17, 5, 9)),
        ("2024-06-01 10:00:00 +05:30", None, us(2024, 6, 1, 4, 30)), ("2024-06-01 24:00:00", None, None), ("x" * 200_000, None, None), (None, None, None), ("", None, None), ("\t20240601T100000Z \n", None, us(2024, 6, 1, 10)), ("0000-00-00 00:00:00", None, None),
    ]
    df = spark.createDataFrame([(i, "f", z, v, None) for i, (v, z, _) in enumerate(cases)] + [(99, "f", None, "01/31/2024 00:00:00", None)], "stamp_id int, file string, zone string, a string, b string")
    df = df.union(df).withColumn("A_", F.lit("x")).withColumn("at", F.lit(1))
    got = {r["stamp_id"]: r["utc_micros"] for r in instants.stamp_instants(df, "stamp_id", ["file"], ["a", "b"], "zone").collect()}
    assert got == {i: u for i, (_, _, u) in enumerate(cases) if u is not None} | {99: us(2024, 1, 31, 5)}
    assert instants.stamp_instants(df.limit(0), "stamp_id", ["file"], ["a", "b"], "zone").count() == 0


# 5


def test_orphans(spark):
    at = lambda d: datetime(2024, 1, d)
    dim = spark.createDataFrame([(1, None, None), (2, at(10), None), (3, None, at(10)), (4, at(5), at(10)), (4, at(20), None), (1, None, None), (None, None, None)], "id long, added timestamp, retired timestamp")
    facts = spark.createDataFrame([(1, 1, 2, at(9)), (2, 2, 3, at(10)), (3, 3, 9, at(9)), (4, 4, 4, at(12)), (5, 4, None, at(20)), (6, 2, 9, None), (7, 4, None, at(1))], "row int, a long, b long, t timestamp")
    facts = facts.withColumn("REASON", F.lit(1)).withColumn("k", F.lit(0))
    refs = references.reference_deltas(facts, ["row"], ["a", "b"], "t")
    spans = references.segments(references.existence_deltas(dim, "id", "added", "retired"))
    got = {(r["row"], r["field_name"], r["reason"]) for r in references.orphans(refs, spans).collect()}
    assert got == {(1, "b", "later"), (2, "b", "deleted"), (3, "b", "missing"), (4, "a", "deleted"), (4, "b", "deleted"), (6, "b", "missing"), (7, "a", "later")}
    assert references.orphans(refs.limit(0), spans).count() == 0
    assert {r["reason"] for r in references.orphans(refs, references.segments(references.existence_deltas(dim.limit(0), "id", "added", "retired"))).collect()} == {"missing"}


def test_counts_from_deltas_in_any_portions(spark):
    d = spark.createDataFrame([(1, 1), (1, 1), (2, 1), (2, -1), (3, 1)], "ref_key long, delta int")
    whole = references.apply_deltas(None, d, ["ref_key"], "refs")
    parts = references.apply_deltas(references.apply_deltas(None, d.where("delta > 0"), ["ref_key"], "refs"), d.where("delta < 0"), ["ref_key"], "refs")
    assert found(whole) == found(parts) == {(1, 2), (3, 1)}
    alive = spark.createDataFrame([(1, 1)], "ref_key long, existing int")
    assert found(references.orphan_keys(whole, alive, ["ref_key"])) == {(3, 1)}


def test_streamed_counts(spark, tmp_path):
    from quaystone.streaming.deltas import CountState

    src = tmp_path / "src"
    spark.createDataFrame([(1, 1), (2, 1)], "ref_key long, delta int").write.parquet(str(src))
    state = CountState(spark, tmp_path / "state", ["ref_key"], "refs")
    for _ in range(2):
        stream = spark.readStream.schema("ref_key long, delta int").parquet(str(src))
        state.follow(stream, tmp_path / "ck").awaitTermination()
        spark.createDataFrame([(2, -1), (3, 1)], "ref_key long, delta int").write.mode("append").parquet(str(src))
    assert found(state.read()) == {(1, 1), (3, 1)}
    state.apply(spark.createDataFrame([(9, 9)], "ref_key long, delta int"), 0)  # delivered again
    assert found(state.read()) == {(1, 1), (3, 1)}


# 6


def test_table_diff(spark):
    nan = float("nan")
    a = [("f", 1, 1.0, "x"), ("f", 2, nan, "é"), ("f", 3, 0.0, None), ("f", 4, None, "t"), (None, 5, 1.0, "n"), ("g", 1, 1.0, "only"), ("d", 1, 1.0, "p"), ("d", 1, 2.0, "p")]
    b = [("f", 1, 1.0, "x"), ("f", 2, nan, "é"), ("f", 3, -0.0, ""), ("f", 4, 1e-300, "t"), (None, 5, 1.0, "n"), ("h", 1, 1.0, "only"), ("d", 1, 2.0, "p"), ("d", 1, 1.0, "q")]
    kind = "k1 string, k2 int, v double, `difference` string"
    left, right = spark.createDataFrame(a * 2, kind).withColumn("_bucket", F.lit(1)), spark.createDataFrame(b[::-1], kind).withColumn("other", F.lit(1))
    got = found(tablediff.table_diff(left, right, ["k1", "k2"], "only_l", "only_r"))
    assert got == {("f", 2, "difference"), ("f", 3, "difference"), ("f", 4, "v"), ("g", 1, "only_l"), ("h", 1, "only_r"), ("d", 1, "difference"), (None, None, "only_l:_bucket"), (None, None, "only_r:other")}
    cells = {tuple(r) for r in tablediff.table_diff(left, right, ["k1", "k2"], "only_l", "only_r", values=True).collect()}
    assert ("f", 3, "difference", None, "") in cells
    none = left.limit(0)
    assert found(tablediff.table_diff(none, right, ["k1", "k2"], "only_l", "only_r")) == {(r[0], r[1], "only_r") for r in b} | {(None, None, "only_l:_bucket"), (None, None, "only_r:other")}
    assert tablediff.table_diff(none, left.limit(0), ["k1", "k2"], "only_l", "only_r").count() == 0


def test_table_diff_with_a_key_of_a_third_of_all_rows(spark):
    hot = spark.range(30_000).selectExpr("'h' k", "1 v")
    rest = spark.range(60_000).selectExpr("cast(id as string) k", "1 v")
    got = tablediff.table_diff(hot.union(rest), rest.where("k <> '7'").withColumn("v", F.when(F.col("k") == "9", 2).otherwise(1)), ["k"], "l", "r")
    assert found(got) == {("h", "l"), ("7", "l"), ("9", "v")}


# 7


def _spikes(spark, data, bounds=None):
    df = spark.createDataFrame(data, f"{FILE} string, {ORD} bigint, feed_id bigint, v double, c double").withColumn("_block", F.lit(0)).withColumn("n", F.lit(0))
    m = spikes.Model(fields=("v", "c"), leveled=("v",), runs=("v",))
    return {tuple(r)[:3] for r in spikes.implausible(df, m, "feed_id", [FILE, ORD], bounds or {"c": F.col("c") < 0}).where("exact").collect()}


def test_implausible_readings(spark):
    v = {i: float(10 + i % 7) for i in range(1200)}
    v |= {100: 2000.0, 101: -400.0, 102: None, 103: float("nan")} | dict.fromkeys(range(250, 262), 11.5) | dict.fromkeys(range(600, 611), 11.5) | dict.fromkeys(range(700, 712), 12.5)
    v.pop(706)  # a missing ordinal breaks the run
    data = [("f", i, 1, x, -1.0 if i == 5 else 1.0) for i, x in v.items()]
    want = {("f", 100, "v"), ("f", 101, "v"), ("f", 5, "c")} | {("f", i, "v") for i in range(250, 262)}
    assert _spikes(spark, data + data[:300]) == want
    assert _spikes(spark, []) == set()
    assert _spikes(spark, [("g", i, 2, None, None) for i in range(20)] + [(None, 1, 2, 1.0, -1.0), ("g", None, 2, 1.0, -1.0)]) == set()


def _plain_posteriors(m, values, median):
    """Probability of not being normal of each reading of one short file's one field, by loops over the whole chain, after one
    round of expected counts."""
    n, edges = len(values), spikes.LEVELS
    same = [v is not None and ((i > 0 and values[i - 1] == v) or (i + 1 < n and values[i + 1] == v)) for i, v in enumerate(values)]
    level = [None if v is None else len(edges) + 1 if abs(v) > m.times * median else sum(abs(v) / (m.times * median) * m.times >= e for e in edges) for v in values]

    def passes(start, moves, normal, repeat):
        e = [[1.0] * 4 if v is None else [(normal if k == 0 else m.levels[k])[level[i]] * ((0.999 if same[i] else 0.001) if k == 2 else repeat if same[i] else 1 - repeat) * (1 - (m.stray, 0.01, 0.01, 0.99)[k]) for k in range(4)] for i, v in enumerate(values)]
        f, b = [], [[1.0] * 4]
        for i in range(n):
            now = [(start[k] if i == 0 else sum(f[-1][j] * moves[j][k] for j in range(4))) * e[i][k] for k in range(4)]
            f.append([x / sum(now) for x in now])
        for i in range(n - 1, 0, -1):
            now = [sum(moves[j][k] * e[i][k] * b[0][k] for k in range(4)) for j in range(4)]
            b.insert(0, [x / sum(now) for x in now])
        both = [[x * y for x, y in zip(p, q, strict=True)] for p, q in zip(f, b, strict=True)]
        return e, f, b, [[x / sum(p) for x in p] for p in both]

    moves = m.transitions.tolist()
    start = spikes.long_run(m.transitions)
    e, f, b, p = passes(start, moves, m.levels[0], m.repeat)
    sums = np.zeros(spikes.stat_size(m))
    for i in range(n):
        if values[i] is not None:
            sums[level[i]] += p[i][0]
            sums[len(edges) + 2 + (not same[i])] += p[i][0]
        x = np.array([[(f[i - 1] if i else start)[j] * moves[j][k] * e[i][k] * b[i][k] for k in range(4)] for j in range(4)])
        sums[len(edges) + 4 :] += (x / x.sum()).ravel()
    normal, repeat, moves = spikes.fitted(m, sums)
    return [1 - x[0] for x in passes(spikes.long_run(moves)[0], moves[0].tolist(), normal[0], float(repeat[0]))[3]]


def test_posteriors_equal_plain_ones(spark):
    rng = np.random.default_rng(7)
    values = [float(x) for x in np.round(rng.lognormal(2.3, 0.2, 300), 2)]
    values[51], values[90], values[120:140] = None, 900.0, [11.0] * 20
    df = spark.createDataFrame([("f", i, 1, v) for i, v in enumerate(values)], f"{FILE} string, {ORD} bigint, feed_id bigint, v double")
    m = spikes.Model(fields=("v",), leveled=("v",), runs=("v",))
    got = {r[ORD]: r["probability"] for r in spikes.implausible(df, m, "feed_id", [FILE, ORD], {}).collect()}
    want = _plain_posteriors(m, values, float(np.median([v for v in values if v is not None])))
    assert set(got) == {i for i, p in enumerate(want) if p > 0.5 and values[i] is not None} >= {90, *range(120, 140)}
    for i, p in got.items():
        assert abs(p - want[i]) < 1e-6, i


def test_sources_are_judged_by_their_own_model(spark):
    rng = np.random.default_rng(8)
    even = [float(x) for x in np.round(rng.uniform(9, 11, 1500), 3)]
    wild = [float(x) for x in np.round(rng.uniform(9, 11, 1500) * np.where(rng.random(1500) < 0.08, 15, 1), 3)]
    even[700] = wild[700] = 150.0
    data = [("e", i, 1, v, 1.0) for i, v in enumerate(even)] + [("w", i, 2, v, 1.0) for i, v in enumerate(wild)]
    df = spark.createDataFrame(data, f"{FILE} string, {ORD} bigint, feed_id bigint, v double, c double")
    m = spikes.Model(fields=("v", "c"), leveled=("v",), runs=("v",))
    got = {(r[FILE], r[ORD], r["state"], r["exact"]) for r in spikes.implausible(df, m, "feed_id", [FILE, ORD], {}).collect()}
    assert got == {("e", 700, "spike", False)}  # fifteen medians: a spike where all is even, normal where it is usual


def test_whole_file_stuck_across_blocks(spark):
    assert len(_spikes(spark, [("f", i, 1, 3.0, 1.0) for i in range(700)])) == 700


@pytest.mark.parametrize("name", ["p1_found", "p1_cells", "p1_rejected", "p1_scripts", "p2_found", "p2_profile", "p3_found", "p5_found", "p5_report", "p5_keys", "p6_found", "p6_cells", "p7_found"])
def test_problem_sql(spark, name):
    from tests.test_queries import same_as_sql

    same_as_sql(spark, problems, name)


def test_pick(spark):
    from quaystone.runtime import once, pick

    df = spark.range(2).selectExpr("id", "id + 1 as x").toDF("text", "TEXT")
    assert found(pick(df, ["TEXT"])) == {(1,), (2,)} and found(pick(df, ["text"], ["t"])) == {(0,), (1,)}
    twice = spark.createDataFrame([(1, "a", 2.0), (1, "a", 2.0), (2, None, None)], "k int, t string, v double")
    assert found(once(twice, ["k"])) == {(1, "a", 2.0), (2, None, None)} and once(twice, ["k", "t", "v"]).count() == 2
