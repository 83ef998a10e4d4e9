"""Exact ranks, quantiles and distinct counts within groups of any size.

Values are first counted per group, with partial counts before the shuffle. The value axis is cut into ranges at
splitters taken from a summary of all values; a group's part in one range is one unit of work, so a group that holds
most rows is spread over all ranges. Sums per (group, range) give the prefix by which the running counts inside a range
are lifted to ranks within the whole group.

Defined results: null values have no rank; ties share one range of ranks; empty groups do not appear.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Counted values per range, and the largest number of ranges; the splitters are literals of the plan.
ROWS_PER_RANGE, MAX_RANGES = 400_000, 1024


def value_counts(df: DataFrame, groups: list[str], value: str) -> DataFrame:
    return df.where(F.col(value).isNotNull()).groupBy(*groups, value).agg(F.count("*").alias("n"))


def splitters(counts: DataFrame, value: str, ranges: int) -> list[float]:
    if ranges < 2:
        return []
    got = counts.agg(F.percentile_approx(value, [i / ranges for i in range(1, ranges)], 10_000).alias("s")).first()["s"]
    return sorted(set(got or []))


def range_of(value: Column, cuts: list[float]) -> Column:
    """The number of cuts below a value, as a binary decision tree of literals."""

    def tree(lo: int, hi: int) -> Column:
        if lo == hi:
            return F.lit(lo)
        mid = (lo + hi) // 2
        return F.when(value > F.lit(cuts[mid]), tree(mid + 1, hi)).otherwise(tree(lo, mid))

    return tree(0, len(cuts))


def ranked(counts: DataFrame, groups: list[str], value: str, ranges: int | None = None) -> DataFrame:
    """counts (groups..., value, n) with `upto`, the rows of the group up to and with the value, `total` and `distincts`.

    counts is read twice: hand in a settled table or something cheap.
    """
    if ranges is None:
        ranges = min(MAX_RANGES, 1 + counts.count() // ROWS_PER_RANGE)
    parts = counts.withColumn("_r", range_of(F.col(value), splitters(counts, value, ranges)))
    w = Window.partitionBy(*groups, "_r").orderBy(value).rowsBetween(Window.unboundedPreceding, 0)
    run = parts.withColumn("_within", F.sum("n").over(w))
    sums = parts.groupBy(*groups, "_r").agg(F.sum("n").alias("_n"), F.count("*").alias("_d"))
    g = Window.partitionBy(*groups)
    before = F.coalesce(F.sum("_n").over(g.orderBy("_r").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    sums = sums.select(*groups, "_r", before.alias("_before"), F.sum("_n").over(g).alias("total"), F.sum("_d").over(g).alias("distincts"))
    return run.join(sums, [*groups, "_r"]).withColumn("upto", F.col("_within") + F.col("_before")).drop("_r", "_within", "_before")


def quantiles(ranks: DataFrame, groups: list[str], value: str, shares: dict[str, float]) -> DataFrame:
    """(groups..., total, distincts, low, high, <name>...): exact quantiles, the mean of the two middle values where two are."""
    out = [F.first("total").alias("total"), F.first("distincts").alias("distincts"), F.min(value).alias("low"), F.max(value).alias("high")]
    for name, q in shares.items():
        at = F.lit(q) * (F.col("total") - 1)  # position from 0
        for end, pos in (("lo", F.floor(at)), ("hi", F.ceil(at))):
            here = (F.col("upto") > pos) & (F.col("upto") - F.col("n") <= pos)
            out.append(F.max(F.when(here, F.col(value))).alias(f"_{name}_{end}"))
        out.append(F.max(at - F.floor(at)).alias(f"_{name}_t"))
    got = ranks.groupBy(*groups).agg(*out)
    mids = [(F.col(f"_{n}_lo") + (F.col(f"_{n}_hi") - F.col(f"_{n}_lo")) * F.col(f"_{n}_t")).alias(n) for n in shares]
    return got.select(*groups, "total", "distincts", "low", "high", *mids)


def ks_distances(ranks: DataFrame, groups: list[str], value: str, before: DataFrame, link: list[str]) -> DataFrame:
    """(groups..., ks): largest distance between the cumulative curves of a group and of the one before it.

    before maps groups to the former group (columns groups... and previous_<link>). Both curves are merged in one pass by
    value: steps up from one, steps down from the other.
    """
    other = [g for g in groups if g not in link]
    own = ranks.select(*groups, F.col(value).alias("v"), (F.col("n") / F.col("total")).alias("step"))
    prev = ranks.select(*[F.col(g).alias(f"previous_{g}") for g in link], *other, F.col(value).alias("v"), (-F.col("n") / F.col("total")).alias("step"))
    there = before.select(*groups, *[f"previous_{g}" for g in link])
    olds = prev.join(there, [f"previous_{g}" for g in link] + other).select(*groups, "v", "step")
    both = own.join(there.select(*groups), groups, "left_semi").unionByName(olds).groupBy(*groups, "v").agg(F.sum("step").alias("step"))
    cuts = splitters(both, "v", min(MAX_RANGES, 1 + both.count() // ROWS_PER_RANGE))
    both = both.withColumn("_r", range_of(F.col("v"), cuts))
    run = F.sum("step").over(Window.partitionBy(*groups, "_r").orderBy("v").rowsBetween(Window.unboundedPreceding, 0))
    peaks = both.withColumn("_s", run).groupBy(*groups, "_r").agg(F.max("_s").alias("_hi"), F.min("_s").alias("_lo"), F.sum("step").alias("_sum"))
    lift = F.coalesce(F.sum("_sum").over(Window.partitionBy(*groups).orderBy("_r").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    peaks = peaks.withColumn("_b", lift)
    return peaks.groupBy(*groups).agg(F.max(F.greatest(F.abs(F.col("_hi") + F.col("_b")), F.abs(F.col("_lo") + F.col("_b")))).alias("ks"))
