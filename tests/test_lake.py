"""Landing, commit log and whole runs on small synthetic files."""

import json
from datetime import datetime, timedelta

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from quaystone.contracts.versions import Conflict, Damaged, ForeignLayout
from quaystone.functions import measure
from quaystone.plans import pipeline
from quaystone.sources import landing, scan
from quaystone.sources.tablelog import TableLog

RUN = "run"


def write_trips(path, month, rows=400, offset=0.0, current=False, drop=(), extra=None):
    base, out = datetime(2024, month, 5), {n: [] for n in ("VendorID", "tpep_pickup_datetime", "tpep_dropoff_datetime", "passenger_count", "trip_distance", "PULocationID", "DOLocationID", "payment_type", "fare_amount", "tip_amount", "total_amount")}
    for i in range(rows):
        up = base + timedelta(minutes=i)
        off, zone, k = up + timedelta(minutes=11), 1 + i % 40, i % 97
        if k == 5:
            up = None
        elif k == 11:
            up = datetime(2023, 12, 24, 9)
        elif k == 17:
            off = up - timedelta(minutes=9)
        zone = None if k == 23 else 9001 if k == 29 else zone
        fare = i % 50 + offset
        for n, v in zip(out, (1, up, off, (-(2**63) if i == 3 else 1) if current else 1.0, 1.5, zone, 1 + i % 40, 1, fare, 0.5, fare + 1.5), strict=True):
            out[n].append(v)
    out["Airport_fee" if current else "airport_fee"] = [1.25] * rows
    kinds = {"VendorID": pa.int64(), "passenger_count": pa.int64() if current else pa.float64(), "PULocationID": pa.int64(), "DOLocationID": pa.int64()}
    t = pa.table({n: pa.array(v, kinds.get(n, pa.timestamp("us") if "datetime" in n else None)) for n, v in (out | (extra or {})).items() if n not in drop})
    pq.write_table(t, path)
    return path


def write_zones(path, n=40):
    path.write_text("LocationID,Borough,Zone,service_zone\n" + "".join(f"{i},Borough {i},Zone {i},Boro\n" for i in range(1, n + 1)), encoding="utf-8-sig")
    return path


@pytest.fixture
def lake(spark, tmp_path):
    lake = pipeline.Lake(spark, tmp_path / "landing", tmp_path / "warehouse")
    lake.land("yellow", "2024-01", write_trips(tmp_path / "a.parquet", 1), RUN, "2024-02-01")
    lake.land("yellow", "2024-02", write_trips(tmp_path / "b.parquet", 2, current=True), RUN, "2024-03-01")
    assert lake.land_zones(write_zones(tmp_path / "z.csv"), RUN)["state"] == "published"
    return lake


ASKED = [("yellow", "2024-01"), ("yellow", "2024-02")]


def test_landing(tmp_path):
    store, who = landing.Store(tmp_path / "s"), landing.Identity("trip", "synthetic_fixture", "yellow", "2024-01")
    f = write_trips(tmp_path / "a.parquet", 1)
    get = lambda **k: store.acquire(who, landing.local_file(f), landing.validate_parquet, RUN, **k)
    one = get()
    assert one["state"] == "published" and get()["state"] == "replayed"
    landed = store.file_path(who, one["version_id"])
    landed.write_bytes(b"broken")
    assert get()["state"] == "repaired" and landing.sha256_file(landed) == one["content_sha256"]
    landed.unlink()
    assert get()["state"] == "repaired"
    assert get(expected_bytes=1)["state"] == "rejected" and get(expected_sha256="0" * 64)["state"] == "rejected"
    manifest = store.manifest_path(who, one["version_id"])
    manifest.write_text(manifest.read_text().replace("synthetic_fixture", "bounded_sample"))
    assert "disagrees" in get()["reason"]
    empty = tmp_path / "empty"
    empty.write_bytes(b"")
    assert store.acquire(who, landing.local_file(empty), landing.validate_parquet, RUN)["state"] == "rejected"
    assert not list((tmp_path / "s" / "_incoming").iterdir())
    assert [e["state"] for e in store.events()][:3] == ["published", "replayed", "repaired"]
    write_trips(tmp_path / "a.parquet", 1, offset=1)
    assert get()["state"] == "published" and len(store.versions(who)) == 2


def test_remote_limits(tmp_path):
    class Answer:
        def __init__(self, size, declared=None):
            self.left, self.headers = size, {"Content-Length": declared or 0}

        def __enter__(self):
            return self

        def __exit__(self, *_):
            pass

        def read(self, n):
            n, self.left = min(n, self.left), self.left - min(n, self.left)
            return b"x" * n

    for size, declared in ((5, 50), (50, None)):
        with pytest.raises(ValueError):
            landing.https_file("https://a.test/f", 10, lambda *_a, s=size, d=declared, **_k: Answer(s, d)).write(tmp_path / "f")
    with pytest.raises(ValueError):
        landing.https_file("http://a.test/f")
    tries = []

    def lost():
        tries.append(1)
        raise OSError

    with pytest.raises(OSError):
        landing.with_retries(lost, pause=0)
    assert len(tries) == 3


class Web:
    """Files under URLs, with HEAD and range requests."""

    def __init__(self, files, head=True):
        self.files, self.head, self.moved = files, head, 0

    def __call__(self, request, timeout=None):
        import io
        import urllib.error

        raw, whole = self.files[request.full_url], request.get_method() == "HEAD"
        if whole and not self.head:
            raise urllib.error.HTTPError(request.full_url, 405, "no", {}, None)
        a, _, b = (request.get_header("Range") or f"bytes=0-{len(raw) - 1}").removeprefix("bytes=").partition("-")
        body = raw[int(a) : int(b) + 1]
        answer = io.BytesIO(b"" if whole else body)
        answer.headers = {"Content-Length": str(len(raw) if whole else len(body)), "Content-Range": f"bytes {a}-{b}/{len(raw)}" if not whole else "", "Last-Modified": "then"}
        self.moved += 0 if whole else len(body)
        return answer


def test_remote_inventory_and_sample(tmp_path, monkeypatch, capsys):
    from quaystone.sources import inventory, remote

    files = [inventory.source_file("yellow", 2024, m) for m in (1, 2)]
    raw = {f["url"]: write_trips(tmp_path / f["filename"], f["month"], rows=4000, current=f["month"] == 2).read_bytes() for f in files}
    for web in (Web(raw), Web(raw, head=False)):
        got = remote.remote_inventory(files, 8001, web)
        assert got["services"]["yellow"]["rows"] == 8000 and got["target"] == {"meets_target": False, "rows": 8000, "target_rows": 8001}
        assert got["services"]["yellow"]["changes"]["first_to_last"]["added"] == ["Airport_fee"] and [f["bytes"] for f in got["files"]] == [len(raw[f["url"]]) for f in files]
        assert web.moved < sum(map(len, raw.values()))
    evidence = remote.remote_sample(files[0], 100, tmp_path / "samples", Web(raw))
    path = tmp_path / "samples" / files[0]["filename"]
    assert evidence["rows"] == pq.read_metadata(path).num_rows == 100 and evidence["sha256"] == landing.sha256_file(path) and not evidence["redistributed"]
    assert remote.recorded_hashes([evidence, evidence]) == {("yellow", "2024-01"): evidence["sha256"]}
    with pytest.raises(ValueError):
        remote.recorded_hashes([evidence, evidence | {"sha256": "0"}])
    (tmp_path / "e.json").write_text(json.dumps([evidence]))
    land = lambda period: pipeline.main(["land", "--landing", str(tmp_path / "l"), "--file", f"yellow:{period}={path}", "--evidence", str(tmp_path / "e.json")])
    assert land("2024-01") == 0 and "bounded_sample" in capsys.readouterr().out
    with pytest.raises(ValueError):
        land("2024-02")
    monkeypatch.setattr(remote, "remote_headers", lambda url, opener: landing.remote_headers(url, Web(raw)))
    monkeypatch.setattr(remote.RangeFile.__init__, "__defaults__", (Web(raw),))
    monkeypatch.setattr(remote.remote_inventory, "__defaults__", (Web(raw),))
    monkeypatch.setattr(remote.remote_sample, "__defaults__", (Web(raw),))
    assert pipeline.main(["inventory", "--remote", "yellow:2024-01", "--target-rows", "4000"]) == 0 and '"meets_target": true' in capsys.readouterr().out
    assert pipeline.main(["inventory", "--remote", "yellow:2024-01", "--target-rows", "4001"]) == 1
    capsys.readouterr()
    assert pipeline.main(["sample", "--remote", "yellow:2024-02", "--rows", "7", "--folder", str(tmp_path / "more")]) == 0 and json.loads(capsys.readouterr().out)[0]["rows"] == 7


def test_single_file(spark, tmp_path):
    for n in (3, 5):
        got = scan.bounded_sample(spark.range(9), n, ["id"], str(tmp_path / "s.parquet"))
        assert got.count() == n and pq.read_metadata(tmp_path / "s.parquet").num_rows == n
    assert [p.name for p in tmp_path.iterdir()] == ["s.parquet"]


def test_zone_files(tmp_path):
    assert len(scan.read_zones(write_zones(tmp_path / "z.csv"))) == 40
    for bad in ("LocationID,Borough,Zone\n1,a,b\n", "LocationID,Borough,Zone,service_zone\n1,a,b,c\n1,a,b,c\n", "LocationID,Borough,Zone,service_zone\nx,a,b,c\n", "LocationID,Borough,Zone,service_zone\n"):
        (tmp_path / "bad.csv").write_text(bad)
        with pytest.raises(ValueError):
            scan.read_zones(tmp_path / "bad.csv")


def test_table_log(spark, tmp_path):
    log, df = TableLog(tmp_path / "t"), spark.range(10).selectExpr("id", "cast(id % 2 as string) p")
    assert log.version() == -1
    assert log.append(df, "k1", ["p"])["state"] == "appended" and log.append(df, "k1", ["p"])["state"] == "replayed"
    assert log.append(df.where("id < 0"), "k2", ["p"])["version"] == 1
    assert log.read(spark).count() == 10 and log.read(spark, set()).count() == 0 and log.read(spark, {"k2"}).count() == 0
    lost = tmp_path / "t" / log.files()[0]
    lost.unlink()
    assert log.missing_files() == [log.files()[0]]


def test_commits_of_many_keys(spark, tmp_path):
    """Many keys in one pass: the same rows under each key as single commits give, in few files."""
    df = spark.range(600).selectExpr("id", "if(id % 7 = 0, null, concat('v', id % 50)) v", "if(id % 11 = 0, null, cast(id % 3 as string)) p", "id / 8 x")
    df, values = df.union(df.where("id < 60")), [f"v{n}" for n in range(0, 50, 2)] + ["none such"]
    single, each = TableLog(tmp_path / "single"), TableLog(tmp_path / "each")
    for log in (single, each):
        assert log.append(df.where("v = 'v2'"), "k-v2", ["p"])["state"] == "appended"
    for v in values:
        single.append(df.where(df.v == v), f"k-{v}", ["p"])
    got = each.append_each(df, "v", {v: f"k-{v}" for v in values}, ["p"])
    assert {v for v, x in got.items() if x["state"] == "replayed"} == {"v2"} and {x["version"] for x in got.values()} == {each.version()} == {single.version()} and got["none such"]["files"] == 0
    again = each.append_each(df, "v", {v: f"k-{v}" for v in [*values, "v1"]}, ["p"])
    assert [v for v, x in again.items() if x["state"] == "appended"] == ["v1"]
    single.append(df.where("v = 'v1'"), "k-v1", ["p"])
    for keys in (None, {"k-v2"}, {"k-v2", "k-v4", "k-v8", "k-no"}, {"k-v1", "k-v6"}, {"k-none such"}, set()):
        rows = [sorted(map(str, log.read(spark, keys).collect())) for log in (single, each)]
        assert rows[0] == rows[1] and (bool(rows[0]) or keys in ({"k-none such"}, set())), keys
    assert each.read(spark).columns == df.columns and not each.missing_files() and len(each.files()) < len(single.files()) / 2
    assert set(each.files()) == {str(p.relative_to(tmp_path / "each")) for p in (tmp_path / "each" / "data").rglob("*.parquet")}
    with pytest.raises(ValueError):
        each.append_each(df.withColumnRenamed("x", "_commit_part"), "v", {"v3": "k-v3"}, ["p"])


def test_many_keys_and_another_writer(spark, tmp_path, monkeypatch):
    """A key that another writer commits meanwhile has that writer's rows, once; the others are ours."""
    df, log = spark.range(90).selectExpr("id", "concat('v', id % 3) v", "'p' p"), TableLog(tmp_path / "t")
    TableLog(tmp_path / "t").append(df.where("v = 'v1'"), "v1", ["p"])
    monkeypatch.setattr(log, "committed", lambda key: False)
    got = log.append_each(df, "v", {v: v for v in ("v0", "v1", "v2")}, ["p"])
    assert [got[v]["state"] for v in ("v0", "v1", "v2")] == ["appended", "replayed", "appended"]
    assert sorted(r["id"] for r in log.read(spark).collect()) == list(range(90)) and log.read(spark, {"v1"}).count() == 30
    before = set(log.files())
    assert {x["state"] for x in log.append_each(df, "v", {v: v for v in ("v0", "v1")}, ["p"]).values()} == {"replayed"}
    assert {str(p.relative_to(tmp_path / "t")) for p in (tmp_path / "t" / "data").rglob("*.parquet")} == before


def test_run_rebuild_replay(lake, tmp_path):
    report = pipeline.gated_run(lake, ASKED, tmp_path / "scratch")
    assert report["passed"], report["checks"]
    rows = {o["logical_id"][-7:]: (o["published"], o["quarantined"]) for o in report["run"]["outcomes"]}
    assert rows == {"2024-01": (391, 9), "2024-02": (390, 10)}
    assert report["measured"]["yellow.trip"]["rows"] == 781
    trips = lake.read("yellow", "trip")
    assert len(trips.columns) == 43 and trips.where("pickup_zone_resolved = false and pickup_location_id = 9001").count() == 8
    incidents = {r["rule"]: r["count"] for r in lake.read("yellow", "incident").groupBy("rule").count().collect()}
    assert incidents == {"pickup_timestamp_missing": 10, "negative_duration": 8, "guarded_promotion_out_of_range": 1, "pickup_out_of_declared_period": 10, "zone_key_missing": 8, "zone_key_unknown": 8}


def test_drift_supersession_and_recovery(lake, spark, tmp_path):
    lake.land("yellow", "2024-03", write_trips(tmp_path / "c.parquet", 3, drop=("fare_amount",)), RUN)
    asked = [*ASKED, ("yellow", "2024-03")]
    with pytest.raises(RuntimeError):
        lake.run(asked, RUN, fail_after=1)
    assert lake.catalog.visible()["trip"] == set()  # nothing shows before the boundary
    done = lake.run(asked, RUN)
    assert [m.state for m in lake.catalog.markers()].count("rejected") == 1 and {o["action"] for o in done["outcomes"]} <= {"written", "rejected", "already_published"}
    assert lake.read("yellow", "trip").count() == 781
    assert lake.read("yellow", "incident").where("scope = 'version'").select("rule").first()[0] == "missing_required_column"
    lake.land("yellow", "2024-01", write_trips(tmp_path / "a2.parquet", 1, offset=0.5), RUN, "2024-05-01")
    lake.run([("yellow", "2024-01")], RUN)
    assert lake.read("yellow", "trip").count() == 781 and lake.read("yellow", "trip").where("fare_amount % 1 = 0.5 and source_period = '2024-01'").count() == 391
    lake.land_zones(write_zones(tmp_path / "z2.csv", 30), RUN)
    newest = lake.store.versions(landing.Identity("zone_lookup", "complete_object"))[-1]["version_id"]
    with pytest.raises(Conflict):
        lake.run([("yellow", "2024-01")], RUN, zone_version=newest)
    lake.run(asked, RUN, zone_version=newest)
    change = lake.catalog.transition(lake.catalog.boundary().merged("other", {}), set())
    assert change["is_migration"] and change["changed"] == ["zone_lookup"] and not change["complete"] and len(change["missing"]) == 3 and change["target"]["zone_lookup_version_id"] == "other"
    assert lake.catalog.boundary().zone_lookup_version_id == newest and lake.coverage(asked)["complete"]


def test_rebuild_root_is_guarded(tmp_path):
    keep = tmp_path / "keep"
    keep.mkdir()
    for bad in (keep, keep / "below", tmp_path, "/"):
        with pytest.raises(ValueError):
            pipeline.rebuild_root(bad, [keep])
    own = pipeline.rebuild_root(tmp_path / "own", [keep])
    assert pipeline.rebuild_root(own, [keep]) == own
    other = tmp_path / "other"
    other.mkdir()
    (other / "file").write_text("x")
    with pytest.raises(ValueError):
        pipeline.rebuild_root(other, [keep])


def test_cli(tmp_path, capsys):
    assert pipeline.main(["contracts"]) == 0 and "yellow" in json.loads(capsys.readouterr().out)
    f = write_trips(tmp_path / "a.parquet", 1)
    assert pipeline.main(["inventory", "--file", f"yellow:2024-01={f}", "--file", f"yellow:2024-02={write_trips(tmp_path / 'b.parquet', 2, current=True)}"]) == 0
    got = json.loads(capsys.readouterr().out)
    assert got["services"]["yellow"]["rows"] == 800 and got["services"]["yellow"]["changes"]["first_to_last"]["added"] == ["Airport_fee"]
    assert pipeline.main(["land", "--landing", str(tmp_path / "l"), "--file", f"yellow:2024-01={f}"]) == 0


def test_occurrence_slice(spark, tmp_path):
    from quaystone.plans.slice import Occurrences, executor_hosts, run

    store = landing.Store(tmp_path / "s")
    ids = [landing.Identity("trip", "synthetic_fixture", "yellow", p) for p in ("2024-01", "2024-02")]
    for i, month in zip(ids, (1, 2), strict=True):
        assert store.acquire(i, landing.local_file(write_trips(tmp_path / f"{month}.parquet", month)), landing.validate_parquet, RUN)["state"] == "published"
    report = run(spark, store, tmp_path / "w", ids, RUN)
    assert report["passed"] and [a["state"] for a in report["artifacts"]] == ["appended", "appended"], report
    t = Occurrences(spark, tmp_path / "w", "yellow")
    assert t.versions() == {a["version_id"] for a in report["artifacts"]} and t.read().count() == 800
    with pytest.raises(ValueError):
        t.read("x' OR 1=1")
    with pytest.raises(ValueError):
        t.ingest(tmp_path / "1.parquet", {"version_id": "0" * 64, "completeness": "bounded_sample"}, RUN)
    assert executor_hosts(spark, 2)


def test_two_writers(spark, tmp_path):
    from concurrent.futures import ThreadPoolExecutor

    log, df = TableLog(tmp_path / "t"), spark.range(50).selectExpr("id", "'p' p")
    with ThreadPoolExecutor(4) as pool:
        states = [f.result()["state"] for f in [pool.submit(TableLog(tmp_path / "t").append, df, k, ["p"]) for k in ("a", "b", "a", "c")]]
    assert sorted(states) == ["appended"] * 3 + ["replayed"] and log.version() == 2 and log.read(spark).count() == 150 and not log.missing_files()


WRITER = """
import sys
from quaystone.runtime import session
from quaystone.sources.tablelog import TableLog
s = session("writer", 1, 1)
df = s.range(20).selectExpr("id", "'p' p")
print([TableLog(sys.argv[1]).append(df, k, ["p"])["state"] for k in ("same", "same too", sys.argv[2])])
s.stop()
"""


def test_two_drivers(spark, tmp_path):
    """Two processes that commit the same keys and one of their own each; what they leave is verified by a third."""
    import subprocess
    import sys
    from pathlib import Path

    root = str(Path(__file__).resolve().parent.parent)
    runs = [subprocess.Popen([sys.executable, "-c", WRITER, str(tmp_path / "t"), own], cwd=root, stdout=subprocess.PIPE, stderr=subprocess.DEVNULL, text=True) for own in ("one", "two")]
    said = [r.communicate(timeout=180)[0] for r in runs]
    assert all(r.returncode == 0 for r in runs) and sum(x.count("appended") for x in said) == 4 and sum(x.count("replayed") for x in said) == 2, said
    log = TableLog(tmp_path / "t")
    on_disk = {str(p.relative_to(tmp_path / "t")) for p in (tmp_path / "t" / "data").rglob("*.parquet")}
    assert log.version() == 3 and sorted(e["key"] for e in log.entries()) == ["one", "same", "same too", "two"]
    assert log.read(spark).count() == 80 and not log.missing_files() and set(log.files()) == on_disk


def test_foreign_and_damaged_catalogs(lake):
    lake.run(ASKED, RUN)
    catalog = lake.catalog
    marker = next(catalog.root.glob("markers/*/*.json"))
    text = marker.read_text()
    for broken in ("{", "[]", '{"schema_version": 1}', text.replace("2024-0", "2025-0")):
        marker.write_text(broken)
        with pytest.raises(Damaged):
            catalog.markers()
    marker.write_text(text)
    for mark in ('{"schema_version": 1, "table_layout": "other"}', None):
        catalog.layout_path.write_text(mark) if mark else catalog.layout_path.unlink()
        with pytest.raises(ForeignLayout):
            lake.run(ASKED, RUN)
    assert catalog.visible()["trip"]  # refused before anything was written


def test_keys_are_told_from_values(spark):
    a = measure.measure(spark.createDataFrame([(1, "a"), (2, "b")], "k int, t string"), ["k"])
    b = measure.measure(spark.createDataFrame([(1, "a"), (2, "c")], "k int, t string"), ["k"])
    c = measure.measure(spark.createDataFrame([(1, "a"), (3, "b")], "k int, t string"), ["k"])
    differs = lambda x: {k for k, f in measure.compare(a, x)["fields"].items() if not f["match"]}
    assert differs(b) == {"additive_digest", "sorted_digest"} and differs(c) == {"additive_digest", "sorted_digest", "key_additive_digest", "key_sorted_digest"}


def test_sorted_digest_grows(spark, monkeypatch):
    df = measure.row_hashes(spark.range(2000).selectExpr("id % 1500 as id"))
    one = measure.sorted_digest(df).first()
    monkeypatch.setattr(measure, "FOLD", 0.01)  # more levels
    more, again = measure.sorted_digest(df).first(), measure.sorted_digest(df.repartition(7)).first()
    assert more == again and more["row_count"] == one["row_count"] == 2000 and more["digest"] != one["digest"]


def test_a_lake_leaves_the_session_as_it_is(spark, lake):
    assert spark.conf.get("spark.sql.caseSensitive") == "false" and lake.spark.conf.get("spark.sql.caseSensitive") == "true"


def test_samples_need_recorded_hashes(spark, tmp_path):
    lake = pipeline.Lake(spark, tmp_path / "l", tmp_path / "w", "bounded_sample")
    f = write_trips(tmp_path / "a.parquet", 1)
    with pytest.raises(ValueError):
        lake.land("yellow", "2024-01", f, RUN)
    assert lake.land("yellow", "2024-01", f, RUN, recorded={("yellow", "2024-01"): "0" * 64})["state"] == "rejected"
    assert lake.land("yellow", "2024-01", f, RUN, recorded={("yellow", "2024-01"): landing.sha256_file(f)})["state"] == "published"


def test_measure(spark):
    df = spark.createDataFrame([(1, "a", None), (2, "b", datetime(2024, 1, 1, 0, 0, 0, 1))], "k int, t string, at timestamp_ntz")
    other = spark.createDataFrame([(1, "a", None), (2, "b", datetime(2024, 1, 1, 0, 0, 0, 2))], "k int, t string, at timestamp_ntz")
    a, b = measure.measure(df, ["k"]), measure.measure(df.repartition(3), ["k"])
    assert a == b and measure.compare(a, b)["match"]
    assert measure.measure(other, ["k"])["sorted_digest"] != a["sorted_digest"]  # a microsecond counts
    assert measure.measure(df.union(df.limit(1)), ["k"])["sorted_digest"] != a["sorted_digest"]
    assert not measure.compare({}, {})["match"]
    empty = measure.measure(df.where("k > 9"), ["k"])
    assert empty["rows"] == 0 and empty["additive_digest"] is None
    same = measure.alignment(df, df, "k", ["t"]).first()
    assert same["aligned"] and measure.alignment(df, other, "k", ["at"]).first()["first_mismatch"] == 2
    assert not measure.alignment(df.limit(0), df.limit(0), "k", ["t"]).first()["aligned"]


def test_golden_metrics(spark):
    at = lambda *a: datetime(*a)
    rows = [
        (at(2024, 1, 5, 10), at(2024, 1, 5, 10, 12), 132, 48, 10.5, 2.0, 14.5), (at(2023, 12, 31, 23, 55), at(2024, 1, 1, 0, 10), 1, 2, 20.25, 0.0, 23.75), (at(2024, 1, 6, 9), at(2024, 1, 6, 8, 30), 3, 4, 5.0, 1.25, 8.25),
        (at(2024, 1, 7, 12), at(2024, 1, 7, 12, 20), None, None, 7.75, 0.5, 10.75), (at(2024, 1, 8, 8), None, 10, 11, None, None, None),
    ]
    df = spark.createDataFrame(rows, "up timestamp_ntz, off timestamp_ntz, pu int, do int, fare double, tip double, total double")
    got = lambda p: spark.sql(measure.metrics_sql("{t}", p, "up", "off", "pu", "do", ("fare", "tip", "total")), t=df).first().asDict()
    m = got("2024-01")
    assert list(m) == measure.metric_names(("fare", "tip", "total"))
    assert [m[k] for k in ("source_rows", "pickup_out_of_period_rows", "negative_duration_rows", "unresolved_duration_rows", "null_pickup_zone_rows", "null_dropoff_zone_rows")] == [5, 1, 1, 1, 1, 1]
    assert (m["fare_sum_cents"], m["fare_non_null_rows"], m["tip_sum_cents"]) == (4350, 4, 375)
    assert got("2023-12")["pickup_out_of_period_rows"] == 4
