"""Differences between two copies of a table, cell by cell.

Both sides are hashed into buckets by key, each bucket a partition of its own whose number follows the rows; a bucket of
either side arrives as one Arrow table. Keys are turned into one integer each, sorted, and aligned by binary search; the columns of aligned rows are compared through null-aware masks.

Defined results: rows repeated whole count once, thinned out within each batch before the shuffle, so that a row repeated
without end does not fill a bucket; rows of one key that differ are aligned in the order of their values; null keys match
null keys; null equals null only; text is compared by code point, NaN equals NaN, 0.0 equals -0.0; a column that only one
side has is one difference without keys, `<only_...>:<column>`; an empty side leaves all keys of the other as only there.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quaystone.runtime import pick, ship

#: Rows of both sides together that a task holds on average.
ROWS_PER_BUCKET = 60_000


def _unique(t: pa.Table) -> pa.Table:
    return t.group_by(t.column_names, use_threads=False).aggregate([])


def _thin(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        t = _unique(pa.Table.from_batches([b])).select(b.schema.names).cast(b.schema)
        yield from t.combine_chunks().to_batches()


def _codes(columns: list[pa.ChunkedArray]) -> np.ndarray:
    """One integer for each row, equal for rows with equal values in all columns, null included."""
    code = np.zeros(len(columns[0]), dtype=np.int64)
    for c in columns:
        d = pc.dictionary_encode(c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c, null_encoding="encode")
        d = d.combine_chunks() if isinstance(d, pa.ChunkedArray) else d
        part = d.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        code = code * (len(d.dictionary) + 1) + part
        code = np.unique(code, return_inverse=True)[1].astype(np.int64)  # stays below the number of rows
    return code


def _differs(a: pa.ChunkedArray, b: pa.ChunkedArray) -> np.ndarray:
    na, nb = (x.is_null().to_numpy(zero_copy_only=False) if isinstance(x, pa.Array) else x.combine_chunks().is_null().to_numpy(zero_copy_only=False) for x in (a, b))
    ne = pc.fill_null(pc.not_equal(a, b), False)
    out = ne.to_numpy() if isinstance(ne, pa.ChunkedArray) else ne.to_numpy(zero_copy_only=False)
    if pa.types.is_floating(a.type):
        nan = pc.fill_null(pc.and_(pc.is_nan(a), pc.is_nan(b)), False)
        out = out & ~(nan.to_numpy() if isinstance(nan, pa.ChunkedArray) else nan.to_numpy(zero_copy_only=False))
    return (out & ~na & ~nb) | (na ^ nb)


def _ordered(t: pa.Table, keys: list[str], rest: list[str]) -> pa.Table:
    """Distinct rows, those of one key in the order of their values."""
    t = _unique(t)
    order = pc.sort_indices(t, sort_keys=[(c, "ascending") for c in keys + rest])
    return t.take(order)


def _occurrence(code: np.ndarray) -> np.ndarray:
    """How many rows of the same code come before each row; equal codes stand together."""
    if not len(code):
        return code
    start = np.r_[0, np.flatnonzero(np.diff(code)) + 1]
    return np.arange(len(code)) - np.repeat(start, np.diff(np.r_[start, len(code)]))


def table_diff(left: DataFrame, right: DataFrame, keys: list[str], only_left: str, only_right: str, values: bool = False) -> DataFrame:
    """(keys..., difference[, left_value, right_value]): one row for each key on one side and each differing cell."""
    rest = [c for c in dict.fromkeys(left.columns) if c in right.columns and c not in keys]
    spark = left.sparkSession
    ship(spark)
    types, names = dict(left.dtypes), [*keys, *rest]
    ks, cs = [f"k{i}" for i in range(len(keys))], [f"c{i}" for i in range(len(rest))]  # inside, columns go by place
    buckets = max(8, -(-(left.count() + right.count()) // ROWS_PER_BUCKET))
    bucket = F.pmod(F.xxhash64(*ks), F.lit(buckets)).cast("int")
    sides = []
    for side in (left, right):
        rows = pick(side, names, ks + cs)
        rows = rows.select(*[F.col(x).cast(types[n]) for x, n in zip(ks + cs, names, strict=True)])
        sides.append(rows.mapInArrow(_thin, rows.schema).withColumn("_bucket", bucket).repartitionById(buckets, F.col("_bucket")).groupBy("_bucket"))
    schema = ", ".join(f"`{k}` {types[k]}" for k in keys) + ", difference string" + ", left_value string, right_value string" * values

    def compare(a: pa.Table, b: pa.Table) -> pa.Table:
        a, b = (_ordered(t.drop_columns(["_bucket"]), ks, cs) for t in (a, b))
        code = _codes([pa.chunked_array([*a[k].chunks, *b[k].chunks], type=a[k].type) for k in ks])
        ca, cb = code[: len(a)], code[len(a):]
        wide = max([0, *_occurrence(ca), *_occurrence(cb)]) + 1
        ca, cb = ca * wide + _occurrence(ca), cb * wide + _occurrence(cb)
        oa, ob = np.argsort(ca, kind="stable"), np.argsort(cb, kind="stable")
        sa, sb = ca[oa], cb[ob]
        at = np.searchsorted(sb, sa)
        hit = (at < len(sb)) & (sb[np.minimum(at, max(len(sb) - 1, 0))] == sa) if len(sb) else np.zeros(len(sa), bool)
        ia, ib = oa[hit], ob[at[hit]]
        lone = np.ones(len(sb), bool)
        lone[at[hit]] = False
        out = []

        def emit(rows: pa.Table, difference: str, lv: object = None, rv: object = None) -> None:
            columns = [rows[k] for k in ks] + [pa.array([difference] * len(rows), pa.string())]
            if values:
                columns += [x if x is not None else pa.nulls(len(rows), pa.string()) for x in (lv, rv)]
            out.append(pa.table(columns, names=[*keys, "difference", *(["left_value", "right_value"] if values else [])]))

        emit(a.take(oa[~hit]), only_left)
        emit(b.take(ob[lone]), only_right)
        if len(ia):
            a, b = a.take(ia), b.take(ib)
            for c, label in zip(cs, rest, strict=True):
                if (mask := _differs(a[c], b[c])).any():
                    at = np.flatnonzero(mask)
                    emit(a.take(at), label, *((pc.cast(t[c].take(at), pa.string()) for t in (a, b)) if values else ()))
        found = pa.concat_tables(out)
        return _unique(found).select(found.column_names)  # a key stands in one bucket, so this is distinct over all

    found = sides[0].cogroup(sides[1]).applyInArrow(compare, schema)
    apart = [f"{only_left}:{c}" for c in left.columns if c not in right.columns] + [f"{only_right}:{c}" for c in right.columns if c not in left.columns]
    if apart:
        nothing = [F.lit(None).cast(found.schema[c].dataType).alias(c) for c in found.columns]
        found = found.unionByName(spark.createDataFrame([(x,) for x in apart], "difference string").select(*[F.col("difference") if c == "difference" else n for c, n in zip(found.columns, nothing, strict=True)]))
    return found
