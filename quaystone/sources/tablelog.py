"""Tables of Parquet files with a commit log: atomic appends, one commit per transaction key, snapshots.

A commit writes its files aside, moves them into place and creates its entry, which is named by the transaction key,
exclusively: the first creator wins, the other drops its files. Commits of different keys never meet. Whether a key is
committed is one look; entries never change, so a process parses each once. Readers see only files that the log names, and of
files that several commits share only the rows of the commits they ask for.
"""

from __future__ import annotations

import hashlib
import json
import os
import shutil
import time
import uuid
from functools import reduce
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from quaystone.runtime import BROADCAST_ROWS
from quaystone.sources import scan

#: Column of files that several commits share: whose a row is.
PART = "_commit_part"


class TableLog:
    """A table under a folder that all executors share."""

    def __init__(self, root: Path | str):
        self.root = Path(root)
        self.log = self.root / "_log"
        self._known: dict[str, dict] = {}

    def _entry(self, key: str) -> Path:
        return self.log / f"{hashlib.sha256(key.encode()).hexdigest()}.json"

    def _parsed(self, path: Path) -> dict:
        if path.name not in self._known:
            self._known[path.name] = json.loads(path.read_text())
        return self._known[path.name]

    def entries(self) -> list[dict]:
        """All commits, the oldest first."""
        return sorted((self._parsed(p) for p in self.log.glob("*.json")), key=lambda e: (e["committed_at"], e["key"]))

    def version(self) -> int:
        """Number of the last commit, -1 for no table."""
        return sum(1 for _ in self.log.glob("*.json")) - 1

    def committed(self, key: str) -> bool:
        return self._entry(key).exists()

    def append(self, df: DataFrame, key: str, partitions: list[str]) -> dict:
        """Commit df once under a key: `appended`, or `replayed` with nothing written. No rows are a commit too."""
        if self.committed(key):
            return {"state": "replayed", "rows": 0, "version": self.version()}
        staged = self.root / "_staging" / uuid.uuid4().hex
        df.write.partitionBy(*partitions).parquet(scan.as_uri(staged))
        files = self._moved(staged)
        shutil.rmtree(staged, ignore_errors=True)
        if self._entered(key, files, partitions, df.schema):
            return {"state": "appended", "files": len(files), "version": self.version()}
        self._drop(files)  # the other writer was quicker; its files count
        return {"state": "replayed", "rows": 0, "version": self.version()}

    def append_each(self, df: DataFrame, by: str, keys: dict[str, str], partitions: list[str]) -> dict[str, dict]:
        """Commit the rows of every value of the column `by` that is in keys, each value's under its key, in one pass over df.

        As `append` for each value, by value, with the version after all of them. The commits share files, in which a column
        tells whose a row is, so that many small commits make few files. Rows of other values are no part of any commit, and
        a value without rows is a commit too. A failure on the way leaves whole commits of some keys.
        """
        if PART in df.columns:
            raise ValueError(f"{PART} is the name of the column that tells commits apart")
        spark, batch, of, entered = df.sparkSession, uuid.uuid4().hex, {}, {}
        if left := [v for v, k in keys.items() if not self.committed(k)]:
            staged, value, number = self.root / "_staging" / batch, f"_{batch}", f"_{batch}_n"
            numbers = StructType([StructField(value, df.schema[by].dataType), StructField(number, IntegerType())])
            parts = _small(spark.createDataFrame([(v, n) for n, v in enumerate(left)], numbers), len(left))
            rows = df.join(parts, df[by] == parts[value]).drop(value).hint("rebalance", *partitions)
            rows.withColumn(PART, F.concat(F.lit(f"{batch}-"), F.col(number).cast("string"))).drop(number).write.partitionBy(*partitions).parquet(scan.as_uri(staged))
            moved = {Path(f["path"]).name: f for f in self._moved(staged)}
            shutil.rmtree(staged, ignore_errors=True)
            if moved:
                shared = spark.read.schema(f"{PART} string").parquet(*[scan.as_uri(self.root / f["path"]) for f in moved.values()])
                for part, name in shared.select(PART, "_metadata.file_name").distinct().collect():
                    of.setdefault(part, []).append(name)
            for part, v in ((f"{batch}-{n}", v) for n, v in enumerate(left)):
                names = sorted(of.get(part, []))
                if self._entered(keys[v], [moved[n] for n in names], partitions, df.schema, part):
                    entered[v] = names
            self._drop([moved[n] for n in moved.keys() - {n for names in entered.values() for n in names}])  # of keys with which other writers were quicker
        version = self.version()
        return {v: {"state": "appended", "files": len(entered[v]), "version": version} if v in entered else {"state": "replayed", "rows": 0, "version": version} for v in keys}

    def _moved(self, staged: Path) -> list[dict]:
        """The staged files, moved to where the table's data are, each under a name of its own."""
        label, files = uuid.uuid4().hex, []
        for n, p in enumerate(sorted(staged.rglob("*.parquet"))):
            target = self.root / "data" / p.relative_to(staged).parent / f"{label}-{n}-{p.name}"
            target.parent.mkdir(parents=True, exist_ok=True)
            os.replace(p, target)
            files.append({"bytes": target.stat().st_size, "path": str(target.relative_to(self.root))})
        return files

    def _drop(self, files: list[dict]) -> None:
        for f in files:
            (self.root / f["path"]).unlink(missing_ok=True)

    def _entered(self, key: str, files: list[dict], partitions: list[str], schema: StructType, part: str | None = None) -> bool:
        """Create the entry of a commit, which has the files whole or a part of their rows; False if the key has one already."""
        entry = {"committed_at": time.time_ns(), "files": files, "key": key, "partitions": partitions, "schema": json.loads(schema.json())} | ({} if part is None else {"part": part})
        self.log.mkdir(parents=True, exist_ok=True)
        aside = self.log / f".{uuid.uuid4().hex}"
        with aside.open("w") as f:
            f.write(json.dumps(entry, sort_keys=True))
            f.flush()
            os.fsync(f.fileno())
        try:
            os.link(aside, self._entry(key))
            return True
        except FileExistsError:
            return False
        finally:
            aside.unlink(missing_ok=True)

    def _chosen(self, keys: set[str] | None) -> list[dict]:
        return self.entries() if keys is None else [self._parsed(p) for p in map(self._entry, sorted(keys)) if p.exists()]

    def files(self, keys: set[str] | None = None) -> list[str]:
        """The files of all commits or of the given keys', each once."""
        return _paths(self._chosen(keys))

    def missing_files(self) -> list[str]:
        return [f for f in self.files() if not (self.root / f).exists()]

    def read(self, spark: SparkSession, keys: set[str] | None = None) -> DataFrame:
        """The snapshot, or the part of it that the given keys committed; no keys are no rows. Only their files are listed."""
        entries = self.entries()
        if not entries:
            raise FileNotFoundError(f"no table at {self.root}")
        schema = StructType.fromJson(entries[-1]["schema"])
        chosen, sides = self._chosen(keys), []
        if whole := _paths([e for e in chosen if "part" not in e]):
            sides.append(self._scan(spark, whole, schema))
        if shared := _paths(some := [e for e in chosen if "part" in e]):
            parts = _small(spark.createDataFrame([(e["part"],) for e in some], f"{PART} string"), len(some))
            sides.append(self._scan(spark, shared, StructType([*schema.fields, StructField(PART, StringType())])).join(parts, PART, "left_semi"))
        if not sides:
            return spark.createDataFrame([], schema)
        return reduce(DataFrame.union, [df.select(*schema.names) for df in sides])

    def _scan(self, spark: SparkSession, paths: list[str], schema: StructType) -> DataFrame:
        return spark.read.schema(schema).option("basePath", scan.as_uri(self.root / "data")).parquet(*[scan.as_uri(self.root / p) for p in paths])


def _paths(entries: list[dict]) -> list[str]:
    return list(dict.fromkeys(f["path"] for e in entries for f in e["files"]))


def _small(df: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df
