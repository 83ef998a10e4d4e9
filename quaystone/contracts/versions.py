"""Which file of an artifact is current, what was decided before, and what readers may see."""

from __future__ import annotations

import hashlib
import json
import os
import time
from dataclasses import asdict, dataclass
from pathlib import Path

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


class Conflict(RuntimeError):
    """A document exists with other content."""


class Damaged(RuntimeError):
    """A document of the catalog cannot be read, or stands where another belongs."""


class ForeignLayout(RuntimeError):
    """A warehouse holds publications but not in the layout that this package recovers."""


@dataclass(frozen=True)
class Candidate:
    logical_id: str
    version_id: str
    published_at_utc: str
    violations: tuple[str, ...] = ()


def decide(candidates: list[Candidate]) -> list[dict]:
    """active, superseded or rejected for each candidate, whatever their order: the newest without violations is active."""
    out, active = [], {}
    for c in sorted(candidates, key=lambda c: (c.logical_id, c.published_at_utc, c.version_id), reverse=True):
        state = "rejected" if c.violations else "superseded" if c.logical_id in active else "active"
        if state == "active":
            active[c.logical_id] = c.version_id
        out.append({"logical_id": c.logical_id, "state": state, "superseded_by": active[c.logical_id] if state == "superseded" else None, "version_id": c.version_id, "violations": list(c.violations)})
    return out


def decisions(df: DataFrame, artifact: str, version: str, at: str, clean: str) -> DataFrame:
    """df with `decision`: the same as `decide`, over a table of candidates with a boolean column `clean`."""
    newest = F.row_number().over(Window.partitionBy(artifact, clean).orderBy(F.desc(at), F.desc(version)))
    return df.withColumn("decision", F.when(~F.col(clean), "rejected").when(newest == 1, "active").otherwise("superseded"))


def newest(df: DataFrame, artifact: str, version: str, at: str) -> DataFrame:
    """(artifact, version) of the latest row per artifact, with partial aggregates and no sort."""
    return df.groupBy(artifact).agg(F.max(F.struct(at, version)).alias("m")).select(artifact, F.col(f"m.{version}").alias(version))


def ledger_state(events: DataFrame, artifact: str, order: str, version: str, action: str) -> DataFrame:
    """(artifact, active_version) after all events: an activation sets it; a later end of that same version clears it."""
    on = events.where(F.col(action) == "activated").groupBy(artifact).agg(F.max(F.struct(order, version)).alias("m")).select(artifact, F.col(f"m.{order}").alias("_on"), F.col(f"m.{version}").alias(version))
    off = events.where(F.col(action) != "activated").groupBy(artifact, version).agg(F.max(order).alias("_off"))
    state = events.groupBy(artifact).agg(F.count("*").alias("_n")).join(on, artifact, "left").join(off, [artifact, version], "left")
    return state.select(artifact, F.when(F.col("_off").isNull() | (F.col("_off") < F.col("_on")), F.col(version)).alias("active_version"))


def ledger_changes(current: DataFrame, ledger: DataFrame, keys: list[str], order: str, what: list[str]) -> DataFrame:
    """The rows of `current` that differ from the latest ledger event of their key, or have none."""
    latest = ledger.groupBy(*keys).agg(F.max(F.struct(order, *what)).alias("m")).select(*keys, *[F.col(f"m.{c}").alias(f"_{c}") for c in what], F.lit(True).alias("_there"))
    same = F.coalesce(F.col("_there"), F.lit(False))
    for c in what:
        same = same & F.col(c).eqNullSafe(F.col(f"_{c}"))
    return current.join(latest, keys, "left").where(~same).drop("_there", *[f"_{c}" for c in what])


def derivation_id(version_id: str, contract_fingerprint: str, zone_version: str) -> str:
    return hashlib.sha256("\n".join((version_id, contract_fingerprint, zone_version)).encode()).hexdigest()


def derivation_of(version: Column, contract_fingerprint: str, zone_version: str) -> Column:
    """derivation_id over a column of versions."""
    return F.sha2(F.concat_ws("\n", version, F.lit(contract_fingerprint), F.lit(zone_version)), 256)


def version_id(logical_id: str, content_sha256: str) -> str:
    return hashlib.sha256(f"{logical_id}\n{content_sha256}".encode()).hexdigest()


# -- documents --------------------------------------------------------------------------------------------------------


def document_bytes(document: object) -> bytes:
    return (json.dumps(document, indent=2, sort_keys=True, default=str, ensure_ascii=False) + "\n").encode()


def install(path: Path, document: object, overwrite: bool = False) -> str:
    """Write a document as a whole: `installed`, or `unchanged` if it is there already; other content is a conflict.

    Without overwrite the file is created exclusively, so that of two writers one sees the other's content.
    """
    raw = document_bytes(document)
    path.parent.mkdir(parents=True, exist_ok=True)
    if path.exists() and path.read_bytes() == raw:
        return "unchanged"
    part = path.with_name(f".{path.name}.{os.getpid()}.{time.monotonic_ns()}")
    with part.open("wb") as f:
        f.write(raw)
        f.flush()
        os.fsync(f.fileno())
    try:
        if overwrite:
            os.replace(part, path)
            return "installed"
        try:
            os.link(part, path)
            return "installed"
        except FileExistsError:
            if path.read_bytes() == raw:
                return "unchanged"
            raise Conflict(f"{path.name} exists with other content") from None
    finally:
        part.unlink(missing_ok=True)


def append_line(path: Path, event: dict) -> None:
    path.parent.mkdir(parents=True, exist_ok=True)
    with path.open("a", encoding="utf-8") as f:
        f.write(json.dumps(event, sort_keys=True, default=str, ensure_ascii=False) + "\n")


def read_lines(path: Path) -> list[dict]:
    return [json.loads(x) for x in path.read_text(encoding="utf-8").splitlines() if x] if path.exists() else []


@dataclass(frozen=True)
class Boundary:
    """The dimension and the contracts under which the whole dataset is visible."""

    zone_lookup_version_id: str
    contract_fingerprints: dict[str, str]

    def document(self) -> dict:
        return {"contract_fingerprints": dict(sorted(self.contract_fingerprints.items())), "schema_version": 1, "zone_lookup_version_id": self.zone_lookup_version_id}

    @classmethod
    def of(cls, document: dict) -> Boundary:
        return cls(document["zone_lookup_version_id"], dict(document["contract_fingerprints"]))

    def merged(self, zone_version: str, fingerprints: dict[str, str]) -> Boundary:
        return Boundary(zone_version, {**self.contract_fingerprints, **fingerprints})

    def changed(self, target: Boundary) -> list[str]:
        """The dimensions in which a target differs."""
        out = ["zone_lookup"] if self.zone_lookup_version_id != target.zone_lookup_version_id else []
        return out + sorted(f"contract:{s}" for s in target.contract_fingerprints if self.contract_fingerprints.get(s, target.contract_fingerprints[s]) != target.contract_fingerprints[s])


@dataclass(frozen=True)
class Marker:
    """A completed derivation; never changed once there."""

    logical_id: str
    service: str
    period: str
    source_version_id: str
    source_published_at_utc: str
    state: str
    contract_fingerprint: str
    zone_lookup_version_id: str
    derivation_id: str
    violations: tuple[str, ...] = ()

    def document(self) -> dict:
        return {"schema_version": 1, **asdict(self), "violations": list(self.violations)}


LAYOUT = {"schema_version": 1, "table_layout": "contract-fingerprint"}


class Catalog:
    """Markers per derivation, one boundary, and an append-only ledger of decisions, under one folder."""

    def __init__(self, root: Path | str):
        self.root = Path(root)
        self.ledger = self.root / "version_ledger.jsonl"

    def marker_path(self, logical_id: str, derivation: str) -> Path:
        return self.root / "markers" / hashlib.sha256(logical_id.encode()).hexdigest() / f"{derivation}.json"

    def publish(self, m: Marker) -> str:
        if m.state not in ("active", "rejected"):
            raise ValueError(f"a {m.state} version has no marker")
        if any(v.startswith("unreadable") for v in m.violations):
            raise ValueError("a file that could not be read is no deterministic rejection")
        return install(self.marker_path(m.logical_id, m.derivation_id), m.document())

    def markers(self) -> list[Marker]:
        out = []
        for p in sorted(self.root.glob("markers/*/*.json")):
            d = self._document(p)
            try:
                m = Marker(**{k: tuple(v) if k == "violations" else v for k, v in d.items() if k != "schema_version"})
            except TypeError as e:
                raise Damaged(f"{p.name}: {e}") from None
            if self.marker_path(m.logical_id, m.derivation_id) != p:
                raise Damaged(f"{p.parent.name}/{p.name} holds the marker of {m.logical_id}")
            out.append(m)
        return out

    @staticmethod
    def _document(path: Path) -> dict:
        try:
            d = json.loads(path.read_text())
        except ValueError as e:
            raise Damaged(f"{path.name}: {e}") from None
        if not isinstance(d, dict):
            raise Damaged(f"{path.name} is no document")
        return d

    # -- layout

    @property
    def layout_path(self) -> Path:
        return self.root / "layout.json"

    def check_layout(self) -> None:
        """Refuse a warehouse that shows publications without the mark of this layout, or another layout's mark.

        The mark is set before the first write, so that a run that died before its first boundary can be told from a
        warehouse of another kind.
        """
        if self.layout_path.exists():
            if self._document(self.layout_path) != LAYOUT:
                raise ForeignLayout(f"{self.layout_path.name} names another layout")
        elif (self.root / "boundary.json").exists() or any(self.root.glob("markers/*/*.json")):
            raise ForeignLayout("publications without a layout mark: build into a new warehouse")

    def prepare_layout(self) -> str:
        self.check_layout()
        return install(self.layout_path, LAYOUT)

    def has(self, logical_id: str, derivation: str) -> bool:
        return self.marker_path(logical_id, derivation).exists()

    def boundary(self) -> Boundary | None:
        path = self.root / "boundary.json"
        return Boundary.of(self._document(path)) if path.exists() else None

    def covered(self, target: Boundary) -> set[str]:
        """Artifacts with a marker under the target."""
        return {m.logical_id for m in self.markers() if m.zone_lookup_version_id == target.zone_lookup_version_id and m.contract_fingerprint == target.contract_fingerprints.get(m.service)}

    def required(self, target: Boundary) -> set[str]:
        """Artifacts that must be covered before the target may be shown: all, or those of the changed contracts."""
        now, known = self.boundary(), self.markers()
        if now is None:
            return set()
        changed = now.changed(target)
        return {m.logical_id for m in known if "zone_lookup" in changed or f"contract:{m.service}" in changed}

    def missing(self, target: Boundary, requested: set[str]) -> set[str]:
        """What a run over `requested` would leave uncovered; to be asked before the first write."""
        return self.required(target) - self.covered(target) - requested

    def transition(self, target: Boundary, requested: set[str]) -> dict:
        """The document of a change of boundary: what changes, what it requires, what a run over `requested` would leave out."""
        now, required = self.boundary(), self.required(target)
        changed, missing = now.changed(target) if now else [], self.missing(target, requested)
        return {
            "changed": changed, "complete": not missing, "covered": sorted(required & self.covered(target)), "is_migration": bool(now and changed), "missing": sorted(missing),
            "previous": now.document() if now else None, "required": sorted(required), "target": target.document(),
        }

    def settle(self, target: Boundary) -> str:
        """Show the target once everything it requires is covered."""
        if left := self.missing(target, set()):
            raise Conflict(f"not covered: {', '.join(sorted(left))}")
        return install(self.root / "boundary.json", target.document(), overwrite=True)

    def visible(self) -> dict[str, set[str]]:
        """Derivations that readers see, by kind of table: rows of the latest active marker, incidents also of rejections."""
        b = self.boundary()
        if b is None:
            return {"trip": set(), "quarantine": set(), "incident": set()}
        own = [m for m in self.markers() if m.zone_lookup_version_id == b.zone_lookup_version_id and m.contract_fingerprint == b.contract_fingerprints.get(m.service)]
        active: dict[str, Marker] = {}
        for m in sorted((m for m in own if m.state == "active"), key=lambda m: (m.source_published_at_utc, m.source_version_id)):
            active[m.logical_id] = m
        rows = {m.derivation_id for m in active.values()}
        return {"trip": rows, "quarantine": rows, "incident": rows | {m.derivation_id for m in own if m.state == "rejected"}}

    def reconcile(self, decided: list[dict], run_id: str, at: str) -> list[dict]:
        """Append only decisions that differ from the latest of their version."""
        latest = {(e["logical_id"], e["version_id"]): e for e in read_lines(self.ledger)}
        new = []
        for d in decided:
            event = {"action": {"active": "activated"}.get(d["state"], d["state"]), "logical_id": d["logical_id"], "superseded_by": d["superseded_by"], "version_id": d["version_id"], "violations": d["violations"]}
            old = latest.get((d["logical_id"], d["version_id"]))
            if old is None or {k: old.get(k) for k in event} != event:
                new.append({**event, "event_at_utc": at, "run_id": run_id})
        for e in new:
            append_line(self.ledger, e)
        return new

    def active(self) -> dict[str, str | None]:
        """The active version of each artifact, by replaying the ledger."""
        state: dict[str, str | None] = {}
        for e in read_lines(self.ledger):
            if e["action"] == "activated":
                state[e["logical_id"]] = e["version_id"]
            elif state.get(e["logical_id"]) == e["version_id"]:
                state[e["logical_id"]] = None
            else:
                state.setdefault(e["logical_id"], None)
        return state
