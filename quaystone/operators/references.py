"""References to keys that another table does not hold at the time of the reference.

Every change is a signed delta: a reference adds one to its key's reference count; a key's arrival adds one to its
existence count and its retirement takes one away. The running sum of a key's existence deltas cuts time into segments
of constant existence; a reference that falls in a segment of count zero, or whose key has no delta at all, is an orphan.

Defined results: null keys refer to nothing; a null reference time can only be `missing`; a null arrival counts as
"always there", a null retirement as "never"; repeated dimension rows count once; a key added and retired more than once
exists in each of its intervals; empty tables give no orphans (references) or make all references orphans (dimension).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quaystone.runtime import bounded, pick

BEGIN = "timestamp'0001-01-01 00:00:00'"  # SQL literals: expressions need a running session
END = "timestamp'9999-12-31 00:00:00'"


def existence_deltas(dimension: DataFrame, key: str, added: str, retired: str) -> DataFrame:
    """(ref_key, at, delta): +1 when a key arrives, -1 when it is retired."""
    rows = pick(dimension, [key, added, retired], ["ref_key", "a", "r"]).withColumn("a", F.coalesce("a", F.expr(BEGIN))).where("ref_key is not null").distinct()
    return rows.select("ref_key", F.explode(F.array(F.struct(F.col("a").alias("at"), F.lit(1).alias("delta")), F.struct(F.col("r").alias("at"), F.lit(-1).alias("delta")))).alias("d")).select("ref_key", "d.at", "d.delta").where("at is not null")


def reference_deltas(facts: DataFrame, row: list[str], fields: list[str], at: str, sign: int = 1) -> DataFrame:
    """(row..., field_name, ref_key, at, delta): one signed delta for each non-null reference."""
    each = F.explode(F.array(*[F.struct(F.lit(f).alias("field_name"), F.col(f).cast("long").alias("ref_key")) for f in fields]))
    facts = pick(facts, list(dict.fromkeys([*row, *fields, at])))
    return facts.select(*row, F.col(at).alias("at"), each.alias("x")).select(*row, "x.field_name", "x.ref_key", "at", F.lit(sign).alias("delta")).where("ref_key is not null")


def apply_deltas(state: DataFrame | None, deltas: DataFrame, keys: list[str], count: str) -> DataFrame:
    """The state (keys, count) after further deltas; keys whose count is back at zero leave it."""
    new = deltas.groupBy(*keys).agg(F.sum("delta").alias(count))
    both = new if state is None else state.unionByName(new).groupBy(*keys).agg(F.sum(count).alias(count))
    return both.where(F.col(count) != 0)


def segments(deltas: DataFrame) -> DataFrame:
    """(ref_key, since, until, existing, seen, anchor): constant existence over [since, until), all of time for each key."""
    steps = deltas.groupBy("ref_key", "at").agg(F.sum("delta").alias("delta"))
    first = steps.select("ref_key").distinct().select("ref_key", F.expr(BEGIN).alias("at"), F.lit(0).cast("long").alias("delta"))
    steps = first.unionByName(steps).groupBy("ref_key", "at").agg(F.sum("delta").alias("delta"))
    w = Window.partitionBy("ref_key").orderBy("at")
    run = steps.select("ref_key", F.col("at").alias("since"), F.coalesce(F.lead("at").over(w), F.expr(END)).alias("until"), F.sum("delta").over(w).alias("existing"))
    by = Window.partitionBy("ref_key").orderBy("since")
    run = run.withColumn("seen", F.max("existing").over(by) > 0).withColumn("n", F.row_number().over(by))
    best = F.first(F.when(F.col("existing") > 0, F.col("n")), ignorenulls=True).over(by.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    return run.withColumn("anchor", F.col("n") == F.coalesce(best, F.lit(1))).drop("n")


def orphans(references: DataFrame, spans: DataFrame) -> DataFrame:
    """The references (columns of reference_deltas) that meet no existing key, with a `reason`.

    The dimension's segments are broadcast when their number is within the bound, else both sides shuffle on the key and
    adaptive execution splits hot keys. The references themselves are never aggregated into one task.
    """
    side, _ = bounded(spans.select(F.col("ref_key").alias("k"), "since", "until", "existing", "seen", "anchor"))
    within = ((F.col("at") >= F.col("since")) & (F.col("at") < F.col("until"))) | (F.col("at").isNull() & F.col("anchor"))
    met = references.join(side, (F.col("ref_key") == F.col("k")) & within, "left")
    reason = F.when(F.col("k").isNull(), "missing").when(F.col("seen"), "deleted").otherwise("later")
    gone = F.col("k").isNull() | ((F.col("existing") <= 0) & F.col("at").isNotNull())
    return met.where(gone).withColumn("reason", reason).drop("k", "since", "until", "existing", "seen", "anchor")


def orphan_keys(reference_state: DataFrame, existence_state: DataFrame, keys: list[str]) -> DataFrame:
    """Keys with positive references and zero existence: the report as of the last delta."""
    alive = existence_state.where("existing > 0").select("ref_key")
    return reference_state.where("refs > 0").join(alive, "ref_key", "left_anti").select(*keys, "refs")
