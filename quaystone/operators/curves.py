"""Exact quantiles and distances of whole columns from sorted value counts in Arrow batches.

Rows are moved once, by load and stretch of ordinals; each stretch then becomes, per column and value range, one sorted array
of distinct values with their counts. Ranges are cut per column at splitters that hold for all loads, so a load's curve and
that of the load before it are cut alike: equal ranges of both meet in one place, where their arrays are merged. Prefix
counts over the ranges lift what is found within a range to the whole column.

Defined results: null values have no place on a curve; NaN stands above all numbers and counts as one value; 0.0 and -0.0
are one value; a load without values of a column has no quantiles; a distance needs values on either side or stands at 1.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quaystone.runtime import bounded, settle, ship

#: Rows of a partition that are sorted together; values of a column in one range, on average, of all loads; ranges at most.
ROWS_AT_ONCE, ROWS_PER_RANGE, MAX_RANGES = 200_000, 2_000_000, 1024


def splitters(rows: DataFrame, columns: list[str]) -> list[list[float]]:
    """The cuts of each column, none where one range holds all rows."""
    ranges = min(MAX_RANGES, 1 + rows.count() // ROWS_PER_RANGE)
    if ranges < 2:
        return [[] for _ in columns]
    shares = [i / ranges for i in range(1, ranges)]
    got = rows.agg(*[F.percentile_approx(c, shares, 10_000).alias(c) for c in columns]).first()
    return [sorted(set(got[c] or [])) for c in columns]


def pieces(rows: DataFrame, load: str, columns: list[str], ranges: dict[int, tuple[float, float]], cuts: list[list[float]]) -> DataFrame:
    """(load, _column, _range, n, nulls, outside, vals, counts): per stretch, a row of range -1 with the numbers of rows, nulls and
    values outside `ranges`, and a row per range with its values. load is a number; the columns are doubles."""
    ship(rows.sparkSession)
    edges = [np.array(c) for c in cuts]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, count = [], 0
        for b in batches:
            held.append(b)
            count += b.num_rows
            if count >= ROWS_AT_ONCE:
                yield from summed(pa.Table.from_batches(held))
                held, count = [], 0
        if count:
            yield from summed(pa.Table.from_batches(held))

    def summed(t: pa.Table) -> Iterator[pa.RecordBatch]:
        ids, code = np.unique(t[load].to_numpy(), return_inverse=True)
        rows_of = np.bincount(code, minlength=len(ids))
        for k, c in enumerate(columns):
            known = t[c].combine_chunks().is_valid().to_numpy(zero_copy_only=False)
            own, v = code[known], t[c].drop_null().to_numpy() + 0.0  # no negative zero
            lo, hi = ranges.get(k, (-np.inf, np.inf))
            out = np.bincount(own, weights=~((v >= lo) & (v <= hi)), minlength=len(ids)).astype(np.int64) if k in ranges else np.zeros(len(ids), np.int64)
            order = np.lexsort((v, own))
            own, v = own[order], v[order]
            both_nan = np.r_[False, np.isnan(v[1:]) & np.isnan(v[:-1])] if len(v) else np.zeros(0, bool)
            first = np.flatnonzero(np.r_[True, (np.diff(own) != 0) | ((v[1:] != v[:-1]) & ~both_nan[1:])]) if len(v) else np.zeros(0, np.int64)
            n, own, v = np.diff(np.r_[first, len(v)]), own[first], v[first]
            part = np.searchsorted(edges[k], v, side="left")
            start = np.flatnonzero(np.r_[True, (np.diff(own) != 0) | (np.diff(part) != 0)]) if len(v) else np.zeros(0, np.int64)
            total = np.add.reduceat(n, start) if len(v) else np.zeros(0, np.int64)
            offsets = np.r_[np.zeros(len(ids), np.int64), start, len(v)].astype(np.int32)
            zeros = np.zeros(len(start), np.int64)
            yield pa.RecordBatch.from_arrays([
                pa.array(np.r_[ids, ids[own[start]]].astype(np.int32)), pa.array(np.full(len(ids) + len(start), k, np.int32)), pa.array(np.r_[np.full(len(ids), -1), part[start]].astype(np.int32)),
                pa.array(np.r_[rows_of, total].astype(np.int64)), pa.array(np.r_[rows_of - np.bincount(code[known], minlength=len(ids)), zeros].astype(np.int64)), pa.array(np.r_[out, zeros].astype(np.int64)),
                pa.ListArray.from_arrays(pa.array(offsets), pa.array(v)), pa.ListArray.from_arrays(pa.array(offsets), pa.array(n.astype(np.int64))),
            ], names=["load", "_column", "_range", "n", "nulls", "outside", "vals", "counts"])

    schema = "load int, _column int, _range int, n bigint, nulls bigint, outside bigint, vals array<double>, counts array<bigint>"
    return settle(rows.select(load, *columns).mapInArrow(run, schema), "pieces")


def curves(parts: DataFrame, before: DataFrame, shares: dict[str, float]) -> DataFrame:
    """(load, _column, distinct_values, low, high, <name>..., ks) of each column of each load; before maps `load` to `_before`.

    A quantile between two values is their mean weighted by its place between them.
    """
    ship(parts.sparkSession)
    key = ["load", "_column", "_range"]
    own = parts.where("_range >= 0")
    sums = own.groupBy(*key).agg(F.sum("n").alias("_n"))
    whole = Window.partitionBy("load", "_column")
    # a row per load, column and range
    places = settle(sums.select(*key, F.coalesce(F.sum("_n").over(whole.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("prefix"), F.sum("_n").over(whole).alias("total")), "places")
    totals = places.groupBy("load", "_column").agg(F.max("total").alias("total"))
    link, _ = bounded(before.select("load", "_before"))
    # both curves of a pair go to the later load's place; arrays without the load's own totals cannot be scaled there
    mine, _ = bounded(totals)
    earlier = own.withColumnRenamed("load", "_before").join(link, "_before").select(*key, F.lit(True).alias("earlier"), "vals", "counts", F.col("_before").alias("_of"))
    both = own.select(*key, F.lit(False).alias("earlier"), "vals", "counts", F.col("load").alias("_of")).unionByName(earlier)
    both = both.join(mine.select(F.col("load").alias("_of"), "_column", F.col("total").alias("scale")), ["_of", "_column"])
    prefixes, _ = bounded(places.select(*key, "prefix", "total"))
    both = both.join(prefixes, key, "left").select(*key, "earlier", "scale", "prefix", "total", "vals", "counts")
    both = both.repartition(*key).sortWithinPartitions(*key)
    names = list(shares)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for b in batches:
            if b.num_rows:
                held.append(b)
                size += len(b.column(7).flatten())
                if size >= 5 * ROWS_AT_ONCE:
                    t = pa.Table.from_batches(held)
                    k = np.stack([t[c].to_numpy() for c in key])
                    other = np.flatnonzero((k != k[:, -1:]).any(axis=0))  # the last place may go on in the next batch
                    cut = int(other[-1]) + 1 if len(other) else 0
                    if cut:
                        yield merged(t.slice(0, cut))
                    held, size = t.slice(cut).combine_chunks().to_batches(), 0
        if held:
            yield merged(pa.Table.from_batches(held))

    def merged(t: pa.Table) -> pa.RecordBatch:
        k = np.stack([t[c].to_numpy() for c in key])
        begin = np.flatnonzero(np.r_[True, (np.diff(k, axis=1) != 0).any(axis=0)])
        place = np.repeat(np.arange(len(begin)), np.diff(np.r_[begin, len(t)]))
        vals = t["vals"].combine_chunks()
        length = np.diff(vals.offsets.to_numpy())
        v, n = vals.flatten().to_numpy(), t["counts"].combine_chunks().flatten().to_numpy()
        earlier = np.repeat(t["earlier"].to_numpy(), length)
        step = n / np.repeat(t["scale"].to_numpy(), length)
        place = np.repeat(place, length)
        order = np.lexsort((v, place))
        v, n, place, earlier, step = v[order], n[order], place[order], earlier[order], step[order]
        groups = len(begin)
        fresh = np.r_[True, (np.diff(place) != 0) | ((v[1:] != v[:-1]) & ~(np.isnan(v[1:]) & np.isnan(v[:-1])))]
        at = np.flatnonzero(fresh)
        who, value = place[at], v[at]
        mine = np.add.reduceat(np.where(earlier, 0, n), at)  # of each distinct value
        diff = np.add.reduceat(np.where(earlier, -step, step), at)
        first = np.searchsorted(who, np.arange(groups))
        run_ = np.cumsum(diff)
        run_ -= np.repeat(run_[first] - diff[first], np.diff(np.r_[first, len(who)]))
        hi, lo = np.maximum.reduceat(run_, first), np.minimum.reduceat(run_, first)
        there = mine > 0
        w, x, c = who[there], value[there], np.cumsum(mine[there])
        count = np.bincount(w, weights=mine[there], minlength=groups).astype(np.int64)
        distinct = np.bincount(w, minlength=groups)
        a, b = np.searchsorted(w, np.arange(groups), side="left"), np.searchsorted(w, np.arange(groups), side="right") - 1
        has = distinct > 0
        number = lambda i: pa.array(np.where(has, x[np.minimum(np.where(has, i, 0), max(len(x) - 1, 0))], 0.0) if len(x) else np.zeros(groups), mask=~has)
        prefix, total = (np.where(has, t[z].to_pandas().fillna(0).to_numpy()[begin], 0).astype(np.int64) for z in ("prefix", "total"))
        base = np.where(has, np.r_[0, c][np.where(has, a, 0)], 0)
        out = []
        for q in shares.values():
            spot = q * (total - 1)
            for p in (np.floor(spot).astype(np.int64), np.ceil(spot).astype(np.int64)):
                local = p - prefix
                inside = has & (local >= 0) & (local < count)
                i = np.searchsorted(c, base + np.where(inside, local, 0), side="right")
                out.append(pa.array(np.where(inside, x[np.minimum(i, len(x) - 1)], 0.0) if len(x) else np.zeros(groups), mask=~inside))
        sums_ = np.add.reduceat(diff, first)
        return pa.RecordBatch.from_arrays([*[pa.array(k[i, begin]) for i in range(3)], pa.array(distinct.astype(np.int64)), number(a), number(b), pa.array(hi), pa.array(lo), pa.array(sums_), *out], names=[*key, "d", "low", "high", "_hi", "_lo", "_sum", *[f"{x}_{e}" for x in names for e in ("lo", "hi")]])

    schema = "load int, _column int, _range int, d bigint, low double, high double, _hi double, _lo double, _sum double, " + ", ".join(f"{x}_lo double, {x}_hi double" for x in names)
    got = both.mapInArrow(run, schema)
    lift = F.coalesce(F.sum("_sum").over(whole.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    got = got.withColumn("_b", lift).groupBy("load", "_column").agg(
        F.sum("d").alias("distinct_values"), F.min("low").alias("low"), F.max("high").alias("high"), F.max(F.greatest(F.abs(F.col("_hi") + F.col("_b")), F.abs(F.col("_lo") + F.col("_b")))).alias("ks"),
        *[F.max(f"{x}_{e}").alias(f"{x}_{e}") for x in names for e in ("lo", "hi")],
    )
    at = lambda x: F.lit(shares[x]) * (F.col("total") - 1)
    got = got.join(totals, ["load", "_column"], "left").join(link.select("load", F.lit(True).alias("_after")), "load", "left")
    mids = [(F.col(f"{x}_lo") + (F.col(f"{x}_hi") - F.col(f"{x}_lo")) * (at(x) - F.floor(at(x)))).alias(x) for x in names]
    return got.select("load", "_column", "distinct_values", "low", "high", *mids, F.when(F.col("_after"), F.col("ks")).alias("ks"))
