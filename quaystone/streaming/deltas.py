"""Reference and existence counts kept up to date from a stream of signed deltas.

The state is a chain of immutable tables in a shared folder, one per micro-batch; a batch delivered again finds its own
table and changes nothing. Each batch is summed per key before it meets the state.
"""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from quaystone.contracts.versions import install
from quaystone.operators.references import apply_deltas
from quaystone.sources import scan


class CountState:
    """(keys..., count) after the last complete batch, under a folder that all executors share."""

    def __init__(self, spark: SparkSession, root: Path | str, keys: list[str], count: str):
        self.spark, self.root, self.keys, self.count = spark, Path(root), keys, count

    def last(self) -> int:
        return max((int(p.stem) for p in (self.root / "done").glob("*.json")), default=-1)

    def read(self, batch: int | None = None) -> DataFrame | None:
        """The state after a batch, None before the first."""
        batch = self.last() if batch is None else batch
        return self.spark.read.parquet(scan.as_uri(self.root / f"batch={batch}")) if batch >= 0 else None

    def apply(self, deltas: DataFrame, batch: int) -> None:
        """Fold one micro-batch into the state, once."""
        if batch <= self.last():
            return
        state = apply_deltas(self.read(), deltas, self.keys, self.count)
        state.write.mode("overwrite").parquet(scan.as_uri(self.root / f"batch={batch}"))
        install(self.root / "done" / f"{batch:012d}.json", {"batch": batch})

    def follow(self, stream: DataFrame, checkpoint: Path | str, **trigger: object) -> StreamingQuery:
        """Keep the state up to date from a stream with the key columns and `delta`."""
        writer = stream.writeStream.foreachBatch(lambda df, batch: self.apply(df, batch)).option("checkpointLocation", scan.as_uri(checkpoint))
        return writer.trigger(**(trigger or {"availableNow": True})).start()

