"""Mergeable percentiles with bounded error: quantile digests over a bounded universe.

A value becomes the number of its cell, round(value / unit), in a universe of 2**DEPTH cells. A digest is a set of dyadic nodes
(level, place) with counts; a leaf has level 0. Digests of any two sets of rows are merged by adding the counts of equal
nodes. Compression pushes counts up while a node, its sibling and its parent hold at most n // k rows together, which leaves
at most 3 k nodes and misplaces a rank by at most DEPTH * (n // k), whatever the order of merges.

The first and the last cell hold what lies beyond the universe (with a unit of 0.01 beyond 5.49 billion either way); they
are never merged into other nodes, so that their counts stay exact, and a percentile that falls there is infinite.

Leaf counts and their first compression are one Arrow pass over the rows; node addition and queries stay in the JVM; later
compression of groups of at least k rows is Arrow code over pieces of bounded size.

Defined results: null and NaN have no rank; rows delivered twice count once; a group without values has no row; ties fall
into one leaf; the value reported lies within half a unit of a value whose rank is within the bound.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quaystone.runtime import bounded, settle, ship

DEPTH = 40
HALF = 1 << (DEPTH - 1)
#: The cells of values below and above the universe.
BELOW, ABOVE = 0, 2 * HALF - 1
#: Nodes up to which one group is compressed in one task; larger groups are first compressed in pieces.
PIECE_NODES = 1_000_000
#: Rows of a partition that are counted and compressed together.
ROWS_AT_ONCE = 200_000


def compression(rank_error: float) -> int:
    """k for a rank error of that share of the rows."""
    return math.ceil(DEPTH / rank_error)


def cell(value: Column, unit: float) -> Column:
    """The place of a value's leaf in the universe."""
    scaled = F.round(value / unit)
    inside = F.greatest(F.lit(float(-HALF)), F.least(F.lit(float(HALF - 1)), scaled))
    return inside.cast("long") + HALF


def leaves(values: DataFrame, groups: list[str], value: str, unit: float) -> DataFrame:
    """The uncompressed digest (groups..., level, place, n) of each group's values, for any number of values."""
    known = values.where(F.col(value).isNotNull() & ~F.isnan(value))
    return known.select(*groups, F.lit(0).alias("level"), cell(F.col(value), unit).alias("place")).groupBy(*groups, "level", "place").agg(F.count("*").alias("n"))


def add(nodes: DataFrame, groups: list[str]) -> DataFrame:
    """Digests merged by node addition."""
    return nodes.groupBy(*groups, "level", "place").agg(F.sum("n").alias("n"))


def compress_nodes(level: np.ndarray, place: np.ndarray, n: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The compressed digest of one group; nodes are distinct."""
    most = int(n.sum()) // k
    beyond = (level == 0) & ((place == BELOW) | (place == ABOVE))
    kept = [(level[beyond], place[beyond], n[beyond])]
    level, place, n = level[~beyond], place[~beyond], n[~beyond]
    rise = (np.empty(0, np.int64), np.empty(0, np.int64))
    for lv in range(DEPTH + 1):
        at = level == lv
        p, c = np.concatenate([place[at], rise[0]]), np.concatenate([n[at], rise[1]])
        if not len(p):
            rise = (np.empty(0, np.int64), np.empty(0, np.int64))
            continue
        p, back = np.unique(p, return_inverse=True)
        c = np.bincount(back, weights=c).astype(np.int64)
        if lv == DEPTH:
            kept.append((np.full(len(p), lv), p, c))
            break
        parent, back = np.unique(p >> 1, return_inverse=True)
        both = np.bincount(back, weights=c).astype(np.int64)
        above = level == lv + 1
        order = np.argsort(place[above])
        pp, pc = place[above][order], n[above][order]
        i = np.searchsorted(pp, parent)
        have = (i < len(pp)) & (pp[np.minimum(i, max(len(pp) - 1, 0))] == parent) if len(pp) else np.zeros(len(parent), bool)
        total = both + np.where(have, pc[np.minimum(i, max(len(pp) - 1, 0))] if len(pp) else 0, 0)
        lift = total <= most
        stay = ~lift[back]
        kept.append((np.full(int(stay.sum()), lv), p[stay], c[stay]))
        rise = (parent[lift], both[lift])
    return tuple(np.concatenate(x) for x in zip(*kept, strict=True))


def partial_digests(values: DataFrame, groups: list[str], fields: list[str], unit: float, k: int) -> DataFrame:
    """(groups..., field_name, level, place, n): digests of stretches of the rows of each partition, compressed where a
    group has k rows in a stretch. values is read in Arrow batches; ROWS_AT_ONCE rows make a stretch."""
    kinds = dict(values.dtypes)
    ship(values.sparkSession)

    def digests(t: pa.Table) -> Iterator[pa.RecordBatch]:
        code, labels = np.zeros(len(t), np.int64), []
        for g in groups:
            d = t[g].combine_chunks().dictionary_encode(null_encoding="encode")
            d = d.combine_chunks() if isinstance(d, pa.ChunkedArray) else d
            code = code * (len(d.dictionary) + 1) + d.indices.to_numpy(zero_copy_only=False)
        _, first, code = np.unique(code, return_index=True, return_inverse=True)
        for f in fields:
            known = t[f].is_valid().to_numpy(zero_copy_only=False) if isinstance(t[f], pa.Array) else t[f].combine_chunks().is_valid().to_numpy(zero_copy_only=False)
            own, place = code[known], t[f].drop_null().to_numpy()
            if not len(own):
                continue
            order = np.lexsort((place, own))
            own, place = own[order], place[order]
            at = np.flatnonzero(np.r_[True, (np.diff(own) != 0) | (np.diff(place) != 0)])
            n, own, place = np.diff(np.r_[at, len(own)]), own[at], place[at]
            level = np.zeros(len(own), np.int64)
            bounds = np.r_[np.flatnonzero(np.r_[True, np.diff(own) != 0]), len(own)]
            rows = np.add.reduceat(n, bounds[:-1])
            if (rows >= k).any():
                parts = []
                for i, (a, b) in enumerate(zip(bounds[:-1], bounds[1:], strict=True)):
                    lv, p, c = compress_nodes(level[a:b], place[a:b], n[a:b], k) if rows[i] >= k else (level[a:b], place[a:b], n[a:b])
                    parts.append((np.full(len(lv), own[a]), lv, p, c))
                own, level, place, n = (np.concatenate(x) for x in zip(*parts, strict=True))
            take = pa.array(first[own])
            same = [c.combine_chunks() if isinstance(c := t[g].take(take), pa.ChunkedArray) else c for g in groups]
            yield pa.RecordBatch.from_arrays([*same, pa.array([f] * len(own), pa.string()), pa.array(level.astype(np.int32)), pa.array(place), pa.array(n.astype(np.int64))], names=[*groups, "field_name", "level", "place", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, count = [], 0
        for b in batches:
            held.append(b)
            count += b.num_rows
            if count >= ROWS_AT_ONCE:
                yield from digests(pa.Table.from_batches(held))
                held, count = [], 0
        if count:
            yield from digests(pa.Table.from_batches(held))

    cells = [F.when(F.col(f).isNotNull() & ~F.isnan(f), cell(F.col(f), unit)).alias(f) for f in fields]
    schema = ", ".join(f"`{g}` {kinds[g]}" for g in groups) + ", field_name string, level int, place bigint, n bigint"
    return values.select(*groups, *cells).mapInArrow(run, schema)


def _compress(nodes: DataFrame, groups: list[str], k: int) -> DataFrame:
    ship(nodes.sparkSession)
    kinds = dict(nodes.dtypes)
    schema = ", ".join(f"`{g}` {kinds[g]}" for g in groups) + ", level int, place bigint, n bigint"

    def one(t: pa.Table) -> pa.Table:
        lv, p, c = compress_nodes(t["level"].to_numpy(), t["place"].to_numpy(), t["n"].to_numpy(), k)
        same = [pa.chunked_array([pa.repeat(t[g][0], len(p))]) for g in groups]
        return pa.table([*same, pa.array(lv.astype(np.int32)), pa.array(p), pa.array(c)], names=[*groups, "level", "place", "n"])

    return nodes.groupBy(*groups).applyInArrow(one, schema)


def _sides(nodes: DataFrame, groups: list[str], k: int) -> tuple[DataFrame, DataFrame]:
    """The nodes of groups of fewer than k rows, and those of the others. The list of large groups is settled once."""
    many = nodes.groupBy(*groups).agg(F.sum("n").alias("_t")).where(F.col("_t") >= k)
    many, _ = bounded(settle(many.select(*[F.col(g).alias(f"_g{i}") for i, g in enumerate(groups)]), "large"))
    same = F.lit(True)
    for i, g in enumerate(groups):
        same = same & F.col(g).eqNullSafe(F.col(f"_g{i}"))
    return nodes.join(many, same, "left_anti"), nodes.join(many, same, "left_semi")


def _small(nodes: DataFrame, groups: list[str]) -> DataFrame:
    """Groups of fewer than k rows, which need no compression: one shuffle by group serves sums and all that follows."""
    return add(nodes.repartition(*groups), groups)


def _large(nodes: DataFrame, groups: list[str], k: int) -> DataFrame:
    merged = add(nodes, groups)
    count = lambda df: df.groupBy(*groups).agg(F.count("*").alias("c")).agg(F.max("c").alias("m")).first()["m"] or 0
    largest = count(merged)
    while largest > PIECE_NODES:  # any subset of nodes is a digest of some of the rows
        pieces = 1 + largest // PIECE_NODES
        part = merged.withColumn("_piece", F.pmod(F.xxhash64("level", "place"), F.lit(pieces)).cast("int"))
        merged = settle(add(_compress(part, [*groups, "_piece"], k).drop("_piece"), groups), "pieces")
        before, largest = largest, count(merged)
        if 2 * largest > before:  # pieces of 3 k nodes at most: few, and no smaller by another round
            break
    return _compress(merged, groups, k)


def digest(nodes: DataFrame, groups: list[str], k: int) -> DataFrame:
    """One compressed digest per group from any number of digests of its parts."""
    few, many = _sides(nodes, groups, k)
    return _small(few, groups).unionByName(_large(many, groups, k))


def estimates(nodes: DataFrame, groups: list[str], shares: list[float], unit: float, k: int) -> DataFrame:
    """(groups..., percentile, value, n, rank_bound) from any number of digests of each group's parts."""
    few, many = _sides(nodes, groups, k)
    return percentiles(_small(few, groups), groups, shares, unit, k).unionByName(percentiles(_large(many, groups, k), groups, shares, unit, k))


def percentiles(digests: DataFrame, groups: list[str], shares: list[float], unit: float, k: int) -> DataFrame:
    """(groups..., percentile, value, n, rank_bound): estimates from one digest per group."""
    end = F.expr("shiftleft(place + 1, level) - 1")
    leaf = F.col("level") == 0
    last = F.when(leaf & (F.col("place") == BELOW), -1).when(leaf & (F.col("place") == ABOVE), F.lit(2 * HALF)).otherwise(F.least(end, F.lit(ABOVE - 1)))
    nodes = digests.withColumn("_end", last)
    w = Window.partitionBy(*groups)
    upto = F.sum("n").over(w.orderBy("_end", "level").rowsBetween(Window.unboundedPreceding, 0))
    run = nodes.select(*groups, "_end", upto.alias("_upto"), F.sum("n").over(w).alias("n"))
    at = [F.min(F.when(F.col("_upto") >= F.greatest(F.lit(1), F.ceil(F.lit(q) * F.col("n"))), F.col("_end"))).alias(f"_{i}") for i, q in enumerate(shares)]
    got = run.groupBy(*groups).agg(F.first("n").alias("n"), *at)
    value = lambda c: F.when(c < 0, F.lit(float("-inf"))).when(c > ABOVE, F.lit(float("inf"))).otherwise(F.round((c - HALF) * F.lit(unit), 9))
    each = F.explode(F.array(*[F.struct(F.lit(q).alias("percentile"), value(F.col(f"_{i}")).alias("value")) for i, q in enumerate(shares)]))
    bound = F.when(F.col("n") >= k, F.floor(F.col("n") / k) * DEPTH).otherwise(0).cast("long")
    return got.select(*groups, each.alias("x"), "n", bound.alias("rank_bound")).select(*groups, "x.percentile", "x.value", "n", "rank_bound")
