"""Runs over landed files: plan, write, publish, measure, rebuild and replay; and the command line."""

from __future__ import annotations

import argparse
import json
import platform
import shutil
import sys
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import UTC, datetime
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from quaystone.contracts import resolve, rules
from quaystone.contracts.model import CONTRACTS, Contract
from quaystone.contracts.versions import Boundary, Candidate, Catalog, Conflict, Marker, decide, derivation_id, document_bytes
from quaystone.functions import measure
from quaystone.functions.civiltime import transitions
from quaystone.sources import inventory, landing, remote, scan
from quaystone.sources.tablelog import TableLog

KINDS = ("trip", "quarantine", "incident")


#: Versions written, or tables measured, at a time; each is a job of its own, and small ones leave cores idle.
AT_ONCE = 4


def together(call: Callable, items: list) -> list:
    """The results of a call per item, in order, some at a time; the first error is raised once all have ended."""
    with ThreadPoolExecutor(AT_ONCE) as pool:
        return [f.result() for f in [pool.submit(call, x) for x in items]]


@dataclass(frozen=True)
class Planned:
    identity: landing.Identity
    manifest: dict
    resolution: resolve.Resolution
    state: str


class Lake:
    """A landing store, tables per contract fingerprint, and the catalog that says what is visible."""

    def __init__(self, spark: SparkSession, landing_root: Path | str, warehouse: Path | str, completeness: str = "synthetic_fixture"):
        spark = scan.case_sensitive(spark)
        self.spark, self.store, self.root, self.completeness = spark, landing.Store(landing_root), Path(warehouse), completeness
        self.catalog = Catalog(self.root / "catalog")

    # -- landing

    def identity(self, service: str, period: str) -> landing.Identity:
        return landing.Identity("trip", self.completeness, service, period)

    def land(self, service: str, period: str, path: Path | str, run_id: str, published_at_utc: str | None = None, recorded: dict[tuple[str, str], str] | None = None) -> dict:
        """Land a file; a bounded sample needs a recorded hash for its artifact, and a whole object is never taken from a local copy."""
        if self.completeness == "complete_object":
            raise ValueError("a complete object is fetched from its source")
        f, digest = landing.local_file(path), (recorded or {}).get((service, period))
        if self.completeness == "bounded_sample" and digest is None:
            raise ValueError(f"no recorded hash for {service}:{period}")
        return self.store.acquire(self.identity(service, period), landing.Fetched(f.name, f.write, published_at_utc), landing.validate_parquet, run_id, expected_sha256=digest)

    def land_zones(self, path: Path | str, run_id: str) -> dict:
        return self.store.acquire(landing.Identity("zone_lookup", "complete_object"), landing.local_file(path), landing.validate_zones, run_id)

    def zones(self, version: str | None = None) -> tuple[str, DataFrame]:
        """A given version of the zone dimension, else that of the boundary, else the newest."""
        identity = landing.Identity("zone_lookup", "complete_object")
        landed = self.store.versions(identity)
        boundary = self.catalog.boundary()
        version = version or (boundary.zone_lookup_version_id if boundary else None) or (landed[-1]["version_id"] if landed else None)
        if version is None or not (path := self.store.file_path(identity, version)).exists():
            raise FileNotFoundError("no landed zone lookup of that version")
        return version, scan.zone_frame(self.spark, scan.read_zones(path))

    # -- planning

    def plan(self, requested: list[tuple[str, str]], contracts: dict[str, Contract] = CONTRACTS) -> list[Planned]:
        """Every landed version of the requested artifacts with its resolution and decision; reads footers only."""
        items, candidates = [], []
        for service, period in requested:
            identity = self.identity(service, period)
            for m in self.store.versions(identity):
                path = self.store.file_path(identity, m["version_id"])
                try:
                    source = resolve.of_struct(self.spark.read.parquet(scan.as_uri(path)).schema, scan.untyped_columns(path))
                    got = resolve.resolve(contracts[service], source)
                except Exception as e:  # noqa: BLE001  (whatever keeps a file from being read; other artifacts go on)
                    got = resolve.unreadable(contracts[service], str(e))
                items.append((identity, m, got))
                candidates.append(Candidate(identity.logical_id, m["version_id"], m["published_at_utc"], tuple(f"{v.rule}:{v.column}" for v in got.violations)))
        state = {(d["logical_id"], d["version_id"]): d["state"] for d in decide(candidates)}
        return [Planned(i, m, r, state[i.logical_id, m["version_id"]]) for i, m, r in items]

    # -- writing

    def table(self, contract: Contract, kind: str) -> TableLog:
        return TableLog(self.root / "tables" / f"{contract.service}_{kind}" / f"contract={contract.fingerprint()}")

    def _lineage(self, p: Planned, contract: Contract, zone_version: str) -> dict[str, object]:
        m = p.manifest
        return {
            "logical_id": p.identity.logical_id, "source_service": p.identity.service, "source_period": p.identity.period, "source_file_version_id": m["version_id"], "source_published_at_utc": m["published_at_utc"],
            "source_content_sha256": m["content_sha256"], "artifact_completeness": p.identity.completeness, "contract_version": contract.version, "contract_fingerprint": contract.fingerprint(),
            "source_logical_url": (m.get("upstream") or {}).get("url") or inventory.source_file(p.identity.service, *inventory.parse_period(p.identity.period))["url"], "zone_lookup_version_id": zone_version,
            "derivation_id": derivation_id(m["version_id"], contract.fingerprint(), zone_version),
        }

    def write(self, p: Planned, contract: Contract, zone_version: str, zones: DataFrame, fail_after: int | None = None) -> dict:
        """The three tables of an active version, each committed once under its derivation; marker last.

        Conservation is counted from one pass over the flags, before anything is committed. fail_after plants a failure
        after that many commits, for tests of recovery.
        """
        lineage = self._lineage(p, contract, zone_version)
        year, month = inventory.parse_period(p.identity.period)
        source = scan.with_ordinal(self.spark, scan.as_uri(self.store.file_path(p.identity, p.manifest["version_id"])))
        rows = rules.evaluated(source, contract, p.resolution, lineage, zones, transitions(year, month, contract.zone)).persist()
        try:
            n = rules.conservation(rows, contract, []).first()
            rules.conserved(n["source_rows"], n["published_rows"], n["quarantined_rows"])
            if n["source_rows"] != scan.footer(self.store.file_path(p.identity, p.manifest["version_id"]))["rows"]:
                raise ArithmeticError("rows read differ from the footer")
            states = {}
            for k, (kind, df) in enumerate(zip(KINDS, (rules.published(rows, contract), rules.quarantined(rows, contract), rules.row_incidents(rows, contract)), strict=True)):
                if fail_after == k:
                    raise RuntimeError("planted failure")
                states[kind] = self.table(contract, kind).append(df, f"{contract.service}:{kind}:{lineage['derivation_id']}", ["source_period"])["state"]
        finally:
            rows.unpersist(blocking=False)
        self._mark(p, lineage, "active")
        return {"action": "written", "derivation_id": lineage["derivation_id"], "published": n["published_rows"], "quarantined": n["quarantined_rows"], "tables": states}

    def reject(self, p: Planned, contract: Contract, zone_version: str) -> dict:
        lineage = self._lineage(p, contract, zone_version)
        df = rules.version_incidents(self.spark, p.resolution, lineage)
        self.table(contract, "incident").append(df, f"{contract.service}:incident:{lineage['derivation_id']}", ["source_period"])
        self._mark(p, lineage, "rejected")
        return {"action": "rejected", "derivation_id": lineage["derivation_id"]}

    def _mark(self, p: Planned, lineage: dict, state: str) -> None:
        self.catalog.publish(Marker(p.identity.logical_id, p.identity.service, p.identity.period, p.manifest["version_id"], p.manifest["published_at_utc"], state, lineage["contract_fingerprint"], lineage["zone_lookup_version_id"], lineage["derivation_id"], tuple(f"{v.rule}:{v.column}" for v in p.resolution.violations)))

    def run(self, requested: list[tuple[str, str]], run_id: str, zone_version: str | None = None, contracts: dict[str, Contract] = CONTRACTS, fail_after: int | None = None) -> dict:
        """Bring the requested artifacts up to date and show them; refuses before the first write what would leave others behind."""
        self.catalog.check_layout()
        zone_version, zones = self.zones(zone_version)
        services = sorted({s for s, _ in requested})
        now = self.catalog.boundary()
        prints = {s: contracts[s].fingerprint() for s in services}
        target = now.merged(zone_version, prints) if now else Boundary(zone_version, prints)
        wanted = {self.identity(s, p).logical_id for s, p in requested}
        if left := self.catalog.missing(target, wanted):
            raise Conflict(f"the change also needs {', '.join(sorted(left))}")
        transition = self.catalog.transition(target, wanted)
        planned = self.plan(requested, contracts)
        self.catalog.prepare_layout()

        def apply(p: Planned) -> dict:
            contract = contracts[p.identity.service]
            derived = derivation_id(p.manifest["version_id"], contract.fingerprint(), zone_version)
            unread = any(v.rule == "unreadable_source_schema" for v in p.resolution.violations)
            if self.catalog.has(p.identity.logical_id, derived):
                outcome = {"action": "already_published"}
            elif p.state == "active":
                outcome = self.write(p, contract, zone_version, zones, fail_after)
            elif p.state == "rejected" and not unread:
                outcome = self.reject(p, contract, zone_version)
            else:
                outcome = {"action": "unreadable" if unread else "superseded_not_published"}
            return {"logical_id": p.identity.logical_id, "version_id": p.manifest["version_id"], **outcome}

        outcomes = together(apply, planned)
        settled = self.catalog.settle(target)
        decided = decide([Candidate(p.identity.logical_id, p.manifest["version_id"], p.manifest["published_at_utc"], tuple(f"{v.rule}:{v.column}" for v in p.resolution.violations)) for p in planned])
        events = self.catalog.reconcile(decided, run_id, datetime.now(UTC).isoformat())
        return {"boundary": settled, "transition": transition, "ledger_events": len(events), "outcomes": outcomes, "promotions": {p.manifest["version_id"]: p.resolution.promotions() for p in planned}}

    # -- reading

    def read(self, service: str, kind: str, contracts: dict[str, Contract] = CONTRACTS) -> DataFrame:
        """The visible rows of a table: only files that visible derivations committed are opened."""
        keys = {f"{service}:{kind}:{d}" for d in self.catalog.visible()[kind]}
        return self.table(contracts[service], kind).read(self.spark, keys)

    def measured(self, contracts: dict[str, Contract] = CONTRACTS) -> dict:
        """Every visible table measured; files that the log names and that are gone are an error."""

        def one(item: tuple[str, str]) -> dict:
            service, kind = item
            if lost := self.table(contracts[service], kind).missing_files():
                raise FileNotFoundError(f"{len(lost)} files of {service} {kind} are gone")
            keys = ["incident_id"] if kind == "incident" else ["source_file_version_id", "source_row_ordinal"]
            return measure.measure(self.read(service, kind, contracts), keys)

        there = [(s, k) for s, c in contracts.items() for k in KINDS if self.table(c, k).version() >= 0]
        return {f"{s}.{k}": m for (s, k), m in zip(there, together(one, there), strict=True)}

    def coverage(self, requested: list[tuple[str, str]]) -> dict:
        b = self.catalog.boundary()
        want = {self.identity(s, p).logical_id for s, p in requested} | {m.logical_id for m in self.catalog.markers()}
        have = self.catalog.covered(b) if b else set()
        return {"complete": want <= have, "covered": sorted(want & have), "missing": sorted(want - have)}

    def table_versions(self, contracts: dict[str, Contract] = CONTRACTS) -> dict[str, int]:
        return {f"{s}.{k}": self.table(c, k).version() for s, c in contracts.items() for k in KINDS}


# -- rebuild and gate -------------------------------------------------------------------------------------------------

OWNED = {"purpose": "quaystone rebuild scratch", "schema_version": 1}


def rebuild_root(path: Path | str, protected: list[Path]) -> Path:
    """An empty folder for a rebuild: outside every protected path, and ours if it is there already."""
    root = Path(path).resolve()
    if root == Path(root.anchor):
        raise ValueError("the file system's root is no scratch folder")
    for p in map(Path.resolve, protected):
        if root == p or root in p.parents or p in root.parents:
            raise ValueError(f"{root} overlaps {p}")
    if any((d / ".git").exists() for d in (root, *root.parents)):
        raise ValueError(f"{root} lies in a checkout")
    mark = root / "rebuild.json"
    if root.exists() and any(root.iterdir()):
        if not mark.exists() or json.loads(mark.read_text()) != OWNED:
            raise ValueError(f"{root} is not ours to clear")
        shutil.rmtree(root)
    root.mkdir(parents=True, exist_ok=True)
    mark.write_bytes(document_bytes(OWNED))
    return root


def runtime(spark: SparkSession) -> dict:
    """What ran; a driver library of another version than the cluster is an error."""
    import pyspark

    if pyspark.__version__.split(".")[:2] != spark.version.split(".")[:2]:
        raise RuntimeError(f"driver library {pyspark.__version__}, cluster {spark.version}")
    return {"platform": platform.platform(), "pyspark": pyspark.__version__, "python": sys.version.split()[0], "spark": spark.version}


def gated_run(lake: Lake, requested: list[tuple[str, str]], scratch: Path | str) -> dict:
    """Run, rebuild from nothing, replay; the five checks that make the result trustworthy."""
    first = lake.run(requested, "run")
    state = lake.measured()
    root = rebuild_root(scratch, [lake.root, lake.store.root])
    fresh = Lake(lake.spark, lake.store.root, root / "warehouse", lake.completeness)
    fresh.run(requested, "rebuild", zone_version=lake.catalog.boundary().zone_lookup_version_id)
    rebuilt, versions = fresh.measured(), lake.table_versions()
    again = lake.run(requested, "replay")
    checks = {
        "incremental_equals_rebuild": measure.compare(state, rebuilt)["match"], "replay_unchanged": lake.measured() == state, "no_new_commit": lake.table_versions() == versions,
        "no_ledger_event": again["ledger_events"] == 0, "all_visible": lake.coverage(requested)["complete"],
    }
    return {"checks": checks, "measured": state, "passed": all(checks.values()), "run": first, "runtime": runtime(lake.spark)}


def main(argv: list[str] | None = None) -> int:
    """land, slice, run, inventory, sample and contracts; the exit code is 0 only if what was asked for holds."""
    parser = argparse.ArgumentParser(prog="quaystone")
    sub = parser.add_subparsers(dest="command", required=True)
    for name in ("land", "slice", "run", "inventory", "sample"):
        p = sub.add_parser(name)
        if name not in ("inventory", "sample"):
            p.add_argument("--landing", required=True)
            p.add_argument("--evidence", help="sample evidence; its files land as bounded samples, by their recorded hashes")
        else:
            p.add_argument("--remote", action="append", default=[], metavar="SERVICE:YYYY-MM")
        if name == "inventory":
            p.add_argument("--year", type=int, help="every month of a year, read by range from the publisher")
            p.add_argument("--target-rows", type=int, default=0)
        if name == "sample":
            p.add_argument("--rows", type=int, default=1000)
            p.add_argument("--folder", required=True)
        if name == "slice":
            p.add_argument("--warehouse", required=True)
        p.add_argument("--file", action="append", default=[], metavar="SERVICE:YYYY-MM=PATH")
        p.add_argument("--zones")
        if name == "run":
            p.add_argument("--warehouse", required=True)
            p.add_argument("--scratch", required=True)
            p.add_argument("--artifact", action="append", default=[], metavar="SERVICE:YYYY-MM")
            p.add_argument("--report")
    sub.add_parser("contracts")
    a = parser.parse_args(argv)
    if a.command == "contracts":
        print(json.dumps({s: {"document": c.document(), "fingerprint": c.fingerprint()} for s, c in CONTRACTS.items()}, indent=2, sort_keys=True))
        return 0
    files = [(inventory.parse_artifact(x.partition("=")[0]), x.partition("=")[2]) for x in a.file]
    if a.command in ("inventory", "sample"):
        asked = [inventory.source_file(s, *inventory.parse_period(p)) for s, p in map(inventory.parse_artifact, a.remote)]
        if a.command == "sample":
            got = [remote.remote_sample(f, a.rows, a.folder) for f in asked]
        else:
            asked += inventory.annual_files(a.year) if a.year else []
            got = remote.remote_inventory(asked, a.target_rows) if asked else inventory.local_inventory(files)
        print(json.dumps(got, indent=2, sort_keys=True))
        return int(a.command == "inventory" and bool(asked) and not got["target"]["meets_target"])
    store, results = landing.Store(a.landing), []
    evidence = json.loads(Path(a.evidence).read_text()) if a.evidence else None
    kind, recorded = ("synthetic_fixture", {}) if evidence is None else ("bounded_sample", remote.recorded_hashes(evidence))
    for (service, period), path in files:
        if evidence is not None and (service, period) not in recorded:
            raise ValueError(f"no recorded hash for {service}:{period}")
        results.append(store.acquire(landing.Identity("trip", kind, service, period), landing.local_file(path), landing.validate_parquet, a.command, expected_sha256=recorded.get((service, period))))
    if a.zones:
        results.append(store.acquire(landing.Identity("zone_lookup", "complete_object"), landing.local_file(a.zones), landing.validate_zones, a.command))
    if a.command == "land":
        print(json.dumps(results, indent=2, sort_keys=True))
        return int(any(r["state"] == "rejected" for r in results))
    from quaystone.runtime import session

    if a.command == "slice":
        from quaystone.plans import slice as occurrence_slice

        asked = [landing.Identity("trip", kind, *f) for f, _ in files]
        got = occurrence_slice.run(session(), store, a.warehouse, asked, "slice")
        print(json.dumps(got, indent=2, sort_keys=True, default=str))
        return int(not got["passed"])
    requested = list(dict.fromkeys([f for f, _ in files] + [inventory.parse_artifact(x) for x in a.artifact]))
    report = gated_run(Lake(session(), a.landing, a.warehouse, kind), requested, a.scratch)
    raw = document_bytes(report)
    if a.report:
        Path(a.report).write_bytes(raw)
    print(json.dumps({"checks": report["checks"], "passed": report["passed"]}, indent=2))
    return int(not report["passed"])


if __name__ == "__main__":
    sys.exit(main())
