"""Remote Parquet files read by range: footers, sizes and bounded samples without fetching whole files."""

from __future__ import annotations

import io
import urllib.request
from collections.abc import Callable
from pathlib import Path

import pyarrow as pa
import pyarrow.parquet as pq

from quaystone.sources import inventory, scan
from quaystone.sources.landing import remote_headers, sha256_file, with_retries


class RangeFile(io.RawIOBase):
    """A remote file as one that can be read anywhere; each read is one range request."""

    def __init__(self, url: str, size: int, opener: Callable = urllib.request.urlopen):
        self.url, self.size, self.opener, self.at, self.moved = url, size, opener, 0, 0

    def readable(self) -> bool:
        return True

    def seekable(self) -> bool:
        return True

    def tell(self) -> int:
        return self.at

    def seek(self, offset: int, whence: int = 0) -> int:
        self.at = max(0, offset + (0, self.at, self.size)[whence])
        return self.at

    def read(self, n: int = -1) -> bytes:
        end = self.size if n is None or n < 0 else min(self.at + n, self.size)
        if end <= self.at:
            return b""

        def ask() -> bytes:
            with self.opener(urllib.request.Request(self.url, headers={"Range": f"bytes={self.at}-{end - 1}"}), timeout=60) as r:
                return r.read()

        got = with_retries(ask)
        if len(got) != end - self.at:
            raise OSError(f"{len(got)} bytes of {end - self.at}")
        self.at, self.moved = end, self.moved + len(got)
        return got


def remote_inventory(files: list[dict], target_rows: int, opener: Callable = urllib.request.urlopen) -> dict:
    """Sizes, footers and schema changes of remote files (as inventory.source_file gives them), and whether their rows meet a target."""
    out: dict = {"files": [], "services": {}}
    schemas: dict[str, dict[str, list[tuple[str, str]]]] = {}
    for f in sorted(files, key=lambda f: (f["service"], f["year"], f["month"])):
        head = remote_headers(f["url"], opener)
        read = pq.ParquetFile(RangeFile(f["url"], head["bytes"], opener))
        columns = [(c.name, str(c.type)) for c in read.schema_arrow]
        period = f"{f['year']:04d}-{f['month']:02d}"
        schemas.setdefault(f["service"], {})[period] = columns
        m = read.metadata
        out["files"].append({"bytes": head["bytes"], "created_by": m.created_by, "last_modified": head["last_modified"], "period": period, "row_groups": m.num_row_groups, "rows": m.num_rows, "schema_fingerprint": scan.schema_fingerprint(columns), "service": f["service"], "url": f["url"]})
    for service, by_period in schemas.items():
        own = [f for f in out["files"] if f["service"] == service]
        out["services"][service] = {"bytes": sum(f["bytes"] for f in own), "changes": inventory.first_and_last(by_period), "files": len(own), "rows": sum(f["rows"] for f in own), "unique_schemas": len(inventory.unique_schemas(by_period))}
    return out | {"target": inventory.meets_target(sum(f["rows"] for f in out["files"]), target_rows)}


def remote_sample(file: dict, rows: int, folder: Path | str, opener: Callable = urllib.request.urlopen) -> dict:
    """The first rows of a remote file as one ZSTD file; only the row groups they lie in are moved. The evidence of the sample."""
    target = Path(folder) / file["filename"]
    target.parent.mkdir(parents=True, exist_ok=True)
    read = pq.ParquetFile(RangeFile(file["url"], remote_headers(file["url"], opener)["bytes"], opener))
    held, left = [], rows
    for b in read.iter_batches(batch_size=max(1, min(rows, 65_536))):
        held.append(b.slice(0, left))
        left -= len(held[-1])
        if left <= 0:
            break
    pq.write_table(pa.Table.from_batches(held, read.schema_arrow), target, compression="zstd")
    return {"bytes": target.stat().st_size, "month": file["month"], "path": target.as_posix(), "redistributed": False, "rows": rows - left, "service": file["service"], "sha256": sha256_file(target), "year": file["year"]}


def recorded_hashes(evidence: list[dict]) -> dict[tuple[str, str], str]:
    """Hashes of samples by (service, period), as landing a bounded sample asks for them; two that differ are an error."""
    out: dict[tuple[str, str], str] = {}
    for e in evidence:
        key = (e["service"], f"{e['year']:04d}-{e['month']:02d}")
        if out.setdefault(key, e["sha256"]) != e["sha256"]:
            raise ValueError(f"two hashes of {key[0]}:{key[1]}")
    return out
