"""Column profiles of each load and what breaks the expected form or departs from the load before.

The columns are unpivoted and counted per (load, column, value) with partial counts, loads and columns by number, as their
names would be most of what is moved; the counts are settled as a table and everything else is read from it: null rates, distinct counts, ranges and patterns by plain aggregates, exact quantiles by
range ranks, Kolmogorov-Smirnov distances by merged cumulative curves, and for texts half the summed difference of shares.

Defined results: repeated rows count once; an all-null column has rates but no quantiles and departs in nothing but its
null rate and distinct count; the first load of a feed is compared with nothing; NaN counts as a value above all numbers.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quaystone.operators import curves, ranks
from quaystone.operators.drift import chained
from quaystone.runtime import bounded, once, pick, settle

#: Ordinals of a load that are moved together.
STRETCH = 65_536
QUARTILES = {"q25": 0.25, "median": 0.5, "q75": 0.75}
MONTH = r"^[0-9]{4}-(0[1-9]|1[0-2])\z"


def _number(rows: DataFrame, column: str) -> Column:
    """A column as a number: times as microseconds, which a double holds exactly for 285 years either way of 1970."""
    c = F.col("`" + column + "`")
    return (F.unix_micros(c.cast("timestamp")) if rows.schema[column].dataType.typeName().startswith("timestamp") else c).cast("double")


class Profile:
    """Profiles of `numbers` and `texts` columns of each load; `_load` and `_column` are the numbers of either."""

    group = ["_load", "_column"]

    def __init__(self, rows: DataFrame, key: list[str], load: str, numbers: list[str], texts: list[str]):
        self.load, self.columns = load, [*numbers, *texts]
        rows = pick(rows, list(dict.fromkeys([*key, load, *numbers, *texts])))
        # one row per load: a table of names, not of data
        self.loads = settle(rows.select(load).distinct().withColumn("_load", F.row_number().over(Window.orderBy(load))), "loads")
        known, _ = bounded(self.loads)
        rows = once(rows, key).withColumnRenamed(load, "_name").join(known, F.col("_name").eqNullSafe(F.col(load)))
        cells = [F.struct(F.lit(i).alias("_column"), _number(rows, c).alias("number"), F.lit(None).cast("string").alias("text")) for i, c in enumerate(numbers)]
        cells += [F.struct(F.lit(i).alias("_column"), F.lit(None).cast("double").alias("number"), F.col(c).alias("text")) for i, c in enumerate(texts, len(numbers))]
        long = rows.select("_load", F.explode(F.array(*cells)).alias("x")).select("_load", "x.*")
        self.counts = settle(long.groupBy(*self.group, "number", "text").agg(F.count("*").alias("n")), "profile")
        self.values = self.counts.where("number is not null").select(*self.group, "number", "n")

    def named(self, columns: list[str]) -> list[int]:
        return [self.columns.index(c) for c in columns]

    def spelled(self, df: DataFrame) -> DataFrame:
        """df with the names of loads and columns for their numbers."""
        known, _ = bounded(self.loads)
        name = F.element_at(F.array(*[F.lit(c) for c in self.columns]), F.col("_column") + 1)
        return df.join(known, "_load").select(self.load, name.alias("column_name"), *[c for c in df.columns if c not in self.group])

    def chain(self, files: DataFrame, feed: list[str], at: str) -> DataFrame:
        """(_load, _before): each load and the one before it in its feed."""
        links = chained(files.join(self.loads, self.load), feed, at, self.load, ["_load"])
        return settle(links.where("previous__load is not null").select("_load", F.col("previous__load").alias("_before")), "chain")

    def basics(self, ranges: dict[str, tuple[float, float]], patterns: dict[str, str]) -> DataFrame:
        known = F.col("number").isNotNull() | F.col("text").isNotNull()
        outside = F.lit(False)
        for c, (lo, hi) in ranges.items():
            outside = outside | ((F.col("_column") == self.columns.index(c)) & ~F.col("number").between(lo, hi))
        broken = F.lit(False)
        for c, p in patterns.items():
            broken = broken | ((F.col("_column") == self.columns.index(c)) & ~F.col("text").rlike(p))
        count = lambda when: F.sum(F.when(when, F.col("n")).otherwise(0))
        return self.counts.groupBy(*self.group).agg(
            F.sum("n").alias("rows"), count(~known).alias("nulls"), count(known & outside).alias("outside"), count(known & broken).alias("broken"),
            F.sum(F.when(known, 1).otherwise(0)).alias("distinct_values"), F.min("number").alias("low"), F.max("number").alias("high"), F.min("text").alias("first_text"), F.max("text").alias("last_text"),
        )

    def ranks(self, columns: list[str] | None = None) -> DataFrame:
        return ranks.ranked(self.values if columns is None else self.values.where(F.col("_column").isin(self.named(columns))), self.group, "number")

    def quantiles(self, shares: dict[str, float], columns: list[str] | None = None) -> DataFrame:
        return ranks.quantiles(self.ranks(columns), self.group, "number", shares).select(*self.group, *shares)

    def shares_distance(self, columns: list[str], chain: DataFrame, value: str = "number") -> DataFrame:
        """(_load, _column, tv): half the summed absolute difference of the values' shares against the load before."""
        some = self.counts.where(F.col(value).isNotNull() & F.col("_column").isin(self.named(columns))).select(*self.group, F.col(value).alias("v"), "n")
        total = some.groupBy(*self.group).agg(F.sum("n").alias("t"))
        share = some.join(total, self.group).select(*self.group, "v", (F.col("n") / F.col("t")).alias("s"))
        link = chain.join(total.select(*self.group), "_load").join(total.select(F.col("_load").alias("_before"), "_column"), ["_before", "_column"])
        now = share.join(link, self.group).select(*self.group, "v", "s")
        old = share.withColumnRenamed("_load", "_before").join(link, ["_before", "_column"]).select(*self.group, "v", (-F.col("s")).alias("s"))
        return now.unionByName(old).groupBy(*self.group, "v").agg(F.sum("s").alias("s")).groupBy(*self.group).agg((F.sum(F.abs("s")) / 2).alias("tv"))


def with_before(stats: DataFrame, chain: DataFrame, columns: list[str]) -> DataFrame:
    """stats with previous_<column> of the load before."""
    old = stats.select(F.col("_load").alias("_before"), "_column", *[F.col(c).alias(f"previous_{c}") for c in columns])
    return stats.join(chain, "_load", "left").join(old, ["_before", "_column"], "left")


def findings(rows: DataFrame, files: DataFrame, key: list[str], load: str, feed: list[str], at: str, ranges: dict, patterns: dict, nulls: list[str], distincts: list[str], medians: list[str], shares: list[str]) -> DataFrame:
    """(load, column_name, finding) by the rules of the parameters; see the registered query for their meaning."""
    p = Profile(rows, key, load, sorted({*ranges, *distincts, *medians, *shares}), sorted(patterns))
    s = p.basics(ranges, patterns)
    chain = p.chain(files, feed, at)
    s = s.join(p.quantiles({"median": 0.5}, medians), p.group, "left")
    s = with_before(s, chain, ["rows", "nulls", "distinct_values", "median"]).join(p.shares_distance(shares, chain), p.group, "left")
    known = F.col("rows") - F.col("nulls")
    of = lambda cs: F.col("_column").isin(p.named(cs))
    tests = {
        "value_range": of([*ranges]) & (known > 0) & (F.col("outside") * 20 >= known),
        "pattern": of([*patterns]) & (known > 0) & (F.col("broken") * 20 >= known),
        "null_rate": of(nulls) & ((F.col("nulls") * F.col("previous_rows") - F.col("previous_nulls") * F.col("rows")) * 10 >= F.col("rows") * F.col("previous_rows")),
        "distinct_count": of(distincts) & (F.col("previous_distinct_values") > 0) & (F.col("distinct_values") * 10 <= F.col("previous_distinct_values")),
        "distribution": (of(medians) & (F.col("previous_median") > 0) & ((F.col("median") >= F.col("previous_median") * 1.5) | (F.col("median") * 1.5 <= F.col("previous_median")))) | (of(shares) & (F.col("tv") >= 0.8 - 1e-12)),
    }
    named = F.array_compact(F.array(*[F.when(t, F.lit(n)) for n, t in tests.items()]))
    return p.spelled(s.select(*p.group, F.explode(named).alias("finding")))


def profile(rows: DataFrame, files: DataFrame, key: list[str], load: str, feed: list[str], at: str, numbers: list[str], texts: list[str], ranges: dict | None = None, patterns: dict | None = None) -> DataFrame:
    """The profile of each column of each load: counts, range, values outside `ranges` and off `patterns`, exact quartiles, and
    the distance from the load before: Kolmogorov-Smirnov for numbers, of shares for texts.

    Numbers go by sorted arrays (see curves): the rows are moved once, not their cells. Texts are counted by value. key is
    (load, ordinal); STRETCH ordinals of a load are moved together.
    """
    ranges, patterns = ranges or {}, patterns or {}
    p = Profile(rows, key, load, [], texts)
    chain = p.chain(files, feed, at)
    s = p.basics({}, patterns)
    s = s.withColumn("broken", F.when(F.col("_column").isin(p.named(list(patterns))), F.col("broken"))).withColumn("outside", F.lit(None).cast("bigint"))
    tv = p.shares_distance(texts, chain, "text").select(*p.group, F.round("tv", 9).alias("text_distance"))
    nothing = [F.lit(None).cast("double").alias(c) for c in (*QUARTILES, "ks")]
    of_texts = p.spelled(s.join(tv, p.group, "left").select(*p.group, "rows", "nulls", "outside", "broken", "distinct_values", "low", "high", "first_text", "last_text", *nothing, "text_distance"))
    known, _ = bounded(p.loads)
    labels = [f"_c{i}" for i in range(len(numbers))]
    moved = pick(rows, list(dict.fromkeys([*key, load, *numbers])))
    moved = moved.withColumnRenamed(load, "_name").join(known, F.col("_name").eqNullSafe(F.col(load)))
    same = [k for k in key if k != load]
    stretch = F.floor(F.col(same[0]) / STRETCH) if same else F.lit(0)
    moved = moved.select("_load", stretch.alias("_stretch"), *same, *[_number(moved, c).alias(x) for c, x in zip(numbers, labels, strict=True)])
    moved = once(moved.repartition("_load", "_stretch"), ["_load", "_stretch", *same])
    parts = curves.pieces(moved, "_load", labels, {numbers.index(c): r for c, r in ranges.items() if c in numbers}, curves.splitters(moved, labels))
    counted = parts.where("_range < 0").groupBy("load", "_column").agg(F.sum("n").alias("rows"), F.sum("nulls").alias("nulls"), F.sum("outside").alias("outside"))
    found = curves.curves(parts, chain.select(F.col("_load").alias("load"), "_before"), QUARTILES)
    of = F.element_at(F.array(*[F.lit(c) for c in numbers]), F.col("_column") + 1)
    got = counted.join(found, ["load", "_column"], "left").withColumnRenamed("load", "_load").join(known, "_load")
    none = F.lit(None).cast("string")
    of_numbers = got.select(load, of.alias("column_name"), "rows", "nulls", F.when(of.isin(list(ranges)), F.col("outside")).alias("outside"), F.lit(None).cast("bigint").alias("broken"), F.coalesce("distinct_values", F.lit(0)).alias("distinct_values"), "low", "high", none.alias("first_text"), none.alias("last_text"), *QUARTILES, F.round("ks", 9).alias("ks"), F.lit(None).cast("double").alias("text_distance"))
    return of_numbers.unionByName(of_texts)
