"""Content-addressed landing: one immutable file and one manifest per version, and a log of what happened."""

from __future__ import annotations

import hashlib
import json
import os
import shutil
import time
import urllib.error
import urllib.request
from collections.abc import Callable
from dataclasses import dataclass
from datetime import UTC, datetime
from pathlib import Path

from quaystone.sources import scan
from quaystone.contracts.versions import append_line, document_bytes, read_lines, version_id

CHUNK, MOST_BYTES = 1 << 20, 4 << 20


@dataclass(frozen=True)
class Identity:
    kind: str
    completeness: str  # complete_object, bounded_sample, synthetic_fixture
    service: str | None = None
    period: str | None = None

    @property
    def logical_id(self) -> str:
        return ":".join(x for x in (self.kind, self.completeness, self.service, self.period) if x)

    @property
    def slug(self) -> str:
        return self.logical_id.replace(":", "__")


@dataclass(frozen=True)
class Fetched:
    name: str
    write: Callable[[Path], None]
    published_at_utc: str | None = None


def sha256_file(path: Path) -> str:
    h = hashlib.sha256()
    with path.open("rb") as f:
        while chunk := f.read(CHUNK):
            h.update(chunk)
    return h.hexdigest()


def local_file(path: Path | str) -> Fetched:
    """A local file under its bare name."""
    return Fetched(Path(path).name, lambda to: shutil.copyfile(path, to) and None)


def with_retries(call: Callable[[], object], attempts: int = 3, pause: float = 1.0) -> object:
    """Again after 1 and 2 pauses for lost connections; an answer that is an HTTP error is final."""
    for k in range(attempts):
        try:
            return call()
        except urllib.error.HTTPError:
            raise
        except OSError:
            if k + 1 == attempts:
                raise
            time.sleep(pause * 2**k)
    raise AssertionError


def remote_headers(url: str, opener: Callable = urllib.request.urlopen) -> dict:
    """Size and time of a remote file by HEAD, or by one byte of its content where HEAD is refused."""

    def ask(method: str, headers: dict) -> dict:
        with opener(urllib.request.Request(url, method=method, headers=headers), timeout=30) as r:
            return {k.lower(): v for k, v in r.headers.items()}

    try:
        h = with_retries(lambda: ask("HEAD", {}))
    except urllib.error.HTTPError as e:
        if e.code not in (403, 405):
            raise
        h = with_retries(lambda: ask("GET", {"Range": "bytes=0-0"}))
    total = h.get("content-range", "").rpartition("/")[2]
    return {"bytes": int(total or h.get("content-length") or 0), "last_modified": h.get("last-modified")}


def https_file(url: str, most: int = MOST_BYTES, opener: Callable = urllib.request.urlopen) -> Fetched:
    """A remote file of at most so many bytes, by its declared and by its streamed size."""

    def write(to: Path) -> None:
        with opener(urllib.request.Request(url), timeout=60) as r, to.open("wb") as f:
            if int(r.headers.get("Content-Length") or 0) > most:
                raise ValueError("declared size is over the limit")
            size = 0
            while chunk := r.read(CHUNK):
                size += len(chunk)
                if size > most:
                    raise ValueError("streamed size is over the limit")
                f.write(chunk)

    if not url.startswith("https://"):
        raise ValueError("only https")
    return Fetched(url.rpartition("/")[2], write)


def validate_parquet(path: Path) -> dict:
    facts = scan.footer(path)
    if not facts["rows"]:
        raise ValueError("no rows")
    return facts


def validate_zones(path: Path) -> dict:
    facts = scan.zone_problems(path)
    if facts["missing_columns"] or facts["duplicate_ids"] or facts["invalid_ids"] or not facts["rows"]:
        raise ValueError(f"zone file: {facts}")
    return facts


class Store:
    def __init__(self, root: Path | str):
        self.root = Path(root)
        self.events_path = self.root / "events.jsonl"

    def file_path(self, identity: Identity, version: str) -> Path:
        return self.root / "files" / identity.slug / version / "artifact"

    def manifest_path(self, identity: Identity, version: str) -> Path:
        return self.root / "manifest" / identity.slug / f"{version}.json"

    def versions(self, identity: Identity) -> list[dict]:
        """Manifests by time of publication."""
        docs = [json.loads(p.read_text()) for p in (self.root / "manifest" / identity.slug).glob("*.json")]
        return sorted(docs, key=lambda d: (d["published_at_utc"], d["version_id"]))

    def events(self) -> list[dict]:
        return read_lines(self.events_path)

    def _log(self, run_id: str, identity: Identity, state: str, version: str | None = None, digest: str | None = None, reason: str | None = None) -> None:
        event = {"content_sha256": digest, "event_at_utc": datetime.now(UTC).isoformat(), "logical_id": identity.logical_id, "run_id": run_id, "state": state, "version_id": version}
        append_line(self.events_path, event | ({"reason": reason} if reason else {}))

    def acquire(self, identity: Identity, fetched: Fetched, validate: Callable[[Path], dict], run_id: str, expected_bytes: int | None = None, expected_sha256: str | None = None, upstream: dict | None = None) -> dict:
        """published, replayed, repaired (the file was lost or damaged) or rejected; nothing half-landed stays."""
        part = self.root / "_incoming" / f"{identity.slug}.{os.getpid()}.{time.monotonic_ns()}"
        part.parent.mkdir(parents=True, exist_ok=True)
        digest = version = None
        try:
            fetched.write(part)
            size = part.stat().st_size
            if not size:
                raise ValueError("empty file")
            if expected_bytes not in (None, size):
                raise ValueError(f"{size} bytes, expected {expected_bytes}")
            digest = sha256_file(part)
            if expected_sha256 not in (None, digest):
                raise ValueError("other content than expected")
            version = version_id(identity.logical_id, digest)
            profile = validate(part)
            target, manifest = self.file_path(identity, version), self.manifest_path(identity, version)
            kept = {"completeness": identity.completeness, "content_length_bytes": size, "content_profile": profile, "content_sha256": digest, "logical_id": identity.logical_id, "period": identity.period, "relative_path": str(target.relative_to(self.root)), "service": identity.service, "version_id": version}
            state = "published"
            if manifest.exists():
                old = json.loads(manifest.read_text())
                if wrong := sorted(k for k, v in kept.items() if old.get(k) != v):
                    raise ValueError(f"manifest disagrees on {', '.join(wrong)}")
                state = "replayed" if target.exists() and sha256_file(target) == digest else "repaired"
            if state != "replayed":
                target.parent.mkdir(parents=True, exist_ok=True)
                os.replace(part, target)
            if state == "published":
                now = datetime.now(UTC).isoformat()
                doc = kept | {"acquired_at_utc": now, "published_at_utc": fetched.published_at_utc or now, "publication_state": "published", "source_name": fetched.name, "upstream": upstream or {}}
                manifest.parent.mkdir(parents=True, exist_ok=True)
                aside = manifest.with_suffix(".part")
                aside.write_bytes(document_bytes(doc))
                os.replace(aside, manifest)
            self._log(run_id, identity, state, version, digest)
            return {"state": state, "version_id": version, "content_sha256": digest, "manifest": json.loads(manifest.read_text())}
        except (OSError, ValueError) as e:
            self._log(run_id, identity, "rejected", version, digest, str(e)[:300])
            return {"state": "rejected", "version_id": version, "content_sha256": digest, "reason": str(e)}
        finally:
            part.unlink(missing_ok=True)
