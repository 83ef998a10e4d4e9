"""Implausible readings per source: a hidden Markov model of each source over its files' sequences of rows.

States are normal, spike, stuck and out of range. A reading shows its level (how many times its size is the source's median),
whether it repeats a neighbour, and whether it breaks a hard bound. A source's own model says how often its normal readings
lie at each level, how often they repeat, and how it moves between the states; it is fitted from the expected counts of a
forward-backward pass under a common model, summed per source from partial sums. A second pass under the source's own model
gives each reading's probabilities, and a reading is flagged when it probably is not normal. So one value can be a spike in a
source of even readings and normal in an uneven one. Hard bounds hold in every model: no normal reading lies beyond `times`
medians or breaks a bound, and normal readings repeat at most every fifth time, so that runs remain stuck.

A file is cut into blocks of ordinals with a halo of neighbours on either side, so that a file of any size is spread over
all tasks; the halo is longer than the shortest run that counts as stuck, so a block sees all that bears on its own rows,
and a chain begins with the states' long-run shares. Medians per source are exact, from ranks by value ranges. What a block
shows is coded in two bytes a reading and settled, so that the second pass reads no rows again.

Defined results: rows delivered twice take the same place in the sequence and count once; of rows that differ and claim one
place, the one of the least values in the order of the fields counts; null readings show nothing; a missing ordinal breaks a
run; rows without file or ordinal belong to no sequence and are passed over; a source whose readings are all null has no
median and no levels, and rows without source follow the common model; NaN repeats nothing and is above nothing.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quaystone.operators import ranks
from quaystone.runtime import bounded, once, pick, settle, ship

BLOCK, CHUNK_ROWS = 512, 100_000
STATES = ("normal", "spike", "stuck", "range")
#: Bounds of the levels, in medians; the last level lies beyond Model.times.
LEVELS = (0.1, 0.25, 0.5, 1.0, 2.0, 4.0, 6.0, 10.0)
SEEN, SAME, BROKEN, EXACT, CORE = 1, 2, 4, 8, 16


@dataclass(frozen=True)
class Model:
    """Fields under watch; leveled ones have levels and spikes, runs ones can be stuck; bound columns are computed by the caller."""

    fields: tuple[str, ...]
    leveled: tuple[str, ...]
    runs: tuple[str, ...]
    times: float = 20.0
    run: int = 12
    halo: int = 32
    #: the common model: probability to leave normal for each other state, to stay stuck, and that a normal reading repeats
    leave: float = 1e-3
    stay: float = 0.95
    repeat: float = 0.05
    #: probability of what no normal reading shows
    stray: float = 1e-9
    #: bounds of what a source can make of `leave`, `stay` and `repeat`
    least_leave: float = 1e-5
    most_leave: float = 0.02
    least_stay: float = 0.9
    most_repeat: float = 0.2
    #: share of a source's readings below which a level of four medians or more is none of its usual ones, and its probability then
    usual: float = 0.005
    unusual: float = 1e-7
    #: readings that the common model is worth beside a source's own
    weight: float = 50.0

    @property
    def levels(self) -> np.ndarray:
        """Probability of each level under each state of the common model."""
        n = np.array([0.03, 0.07, 0.15, 0.25, 0.25, 0.15, 0.05, 0.03, 0.02, self.stray])
        spike = np.array([1e-4, 1e-4, 1e-4, 1e-4, 1e-4, 1e-3, 0.05, 0.15, 0.3, 0.5])
        stuck, beyond = 0.95 * n, 0.7 * n
        stuck[-1], beyond[-1] = 0.05, 0.3
        return np.stack([x / x.sum() for x in (n, spike, stuck, beyond)])

    @property
    def transitions(self) -> np.ndarray:
        n, k = self.leave, self.stay
        return np.array([[1 - 3 * n, n, n, n], [0.9, 0.09, 0.005, 0.005], [1 - k - 0.002, 0.001, k, 0.001], [0.9, 0.005, 0.005, 0.09]])


def stat_size(m: Model) -> int:
    """Expected counts per field: normal readings by level, normal readings that repeat and that do not, moves between states."""
    return len(LEVELS) + 2 + 2 + 16


def fitted(m: Model, sums: np.ndarray | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(levels of normal, repeat of normal, transitions) per field out of a source's expected counts; the common model without any."""
    n, b = len(m.fields), len(LEVELS) + 2
    s = np.zeros((n, stat_size(m))) if sums is None else np.asarray(sums, float).reshape(n, -1)
    level = s[:, :b] + m.levels[0]
    rare = (s[:, :b] < m.usual * s[:, :b].sum(axis=1, keepdims=True)) & (np.arange(b) > LEVELS.index(4.0))
    level[:, -1] = 0
    level = np.where(rare, m.unusual, level / level.sum(axis=1, keepdims=True))
    level[:, -1] = m.stray
    if sums is None:
        level[:] = m.levels[0]
    repeat = np.clip((s[:, b] + m.repeat * m.weight) / (s[:, b] + s[:, b + 1] + m.weight), 1e-3, m.most_repeat)
    moves = s[:, b + 2 :].reshape(n, 4, 4) + m.weight * m.transitions
    moves /= moves.sum(axis=2, keepdims=True)
    away = np.clip(moves[:, 0, 1:], m.least_leave, m.most_leave)
    moves[:, 0, 1:], moves[:, 0, 0] = away, 1 - away.sum(axis=1)
    stay = np.maximum(moves[:, 2, 2], m.least_stay)
    moves[:, 2] *= ((1 - stay) / np.maximum(1 - moves[:, 2, 2], 1e-12))[:, None]
    moves[:, 2, 2] = stay
    return level, repeat, moves


def long_run(moves: np.ndarray) -> np.ndarray:
    """The states' shares in the long run; moves has shape (..., 4, 4)."""
    p = moves
    for _ in range(12):  # 4096 steps
        p = p @ p
    return p[..., 0, :]


def emissions(m: Model, level: np.ndarray, flags: np.ndarray, normal: np.ndarray, repeat: np.ndarray) -> np.ndarray:
    """Likelihood of what each place shows under each state, as (places, 4, sequences); 1 where nothing is seen.

    level and flags are (places, sequences), normal (sequences, levels) and repeat (sequences).
    """
    places, n = level.shape
    e = np.ones((places, 4, n))
    known = level >= 0
    at = np.where(known, level, 0)
    e[:, 0] = np.where(known, normal[np.arange(n)[None], at], 1.0)
    for k in (1, 2, 3):
        e[:, k] = np.where(known, m.levels[k][at], 1.0)
    same, broken = (flags & SAME) > 0, (flags & BROKEN) > 0
    for k in (0, 1, 3):
        e[:, k] *= np.where(same, repeat, 1 - repeat)
    e[:, 2] *= np.where(same, 0.999, 0.001)
    for k, p in enumerate((m.stray, 0.01, 0.01, 0.99)):
        e[:, k] *= np.where(broken, p, 1 - p)
    return np.where(((flags & SEEN) > 0)[:, None], e, 1.0)


def forward_backward(start: np.ndarray, moves: np.ndarray, e: np.ndarray, core: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray | None]:
    """Probabilities of the states at each place, (places, 4, sequences), and with `core` (places, sequences) the expected
    moves into its places, (4, 4, sequences). start is (4, sequences), moves (4, 4, sequences)."""
    places = len(e)
    out, now = np.empty_like(e), start
    for t in range(places):
        now = (now if t == 0 else (now[:, None] * moves).sum(axis=0)) * e[t]
        now = now / now.sum(axis=0)
        out[t] = now
    back, count = np.ones_like(start), np.zeros_like(moves) if core is not None else None
    for t in range(places - 1, -1, -1):
        ahead = back * e[t]
        if t and count is not None:
            x = out[t - 1][:, None] * moves * ahead[None]
            count += x * (core[t] / x.sum(axis=(0, 1)))
        p = out[t] * back
        out[t] = p / p.sum(axis=0)
        back = (moves * ahead[None]).sum(axis=1)
        back = back / back.sum(axis=0)
    return out, count


def run_lengths(same: np.ndarray) -> np.ndarray:
    """Length of the run of equal neighbours each place stands in; same[:, t] says that t repeats t - 1."""
    n, places = same.shape
    start = ~same
    start[:, :1] = True
    flat = np.flatnonzero(start.ravel())
    return np.repeat(np.diff(np.r_[flat, n * places]), np.diff(np.r_[flat, n * places])).reshape(n, places)


def _numbers(column: pa.ChunkedArray) -> np.ndarray:
    return column.to_pandas().to_numpy(dtype=float, na_value=np.nan)


def _shown(m: Model, t: pa.Table, row: list[str]) -> dict:
    """What whole blocks show: files, blocks and sources, and levels and flags as (fields, sequences, places)."""
    file = t[row[0]].combine_chunks().dictionary_encode()
    file = file.combine_chunks() if isinstance(file, pa.ChunkedArray) else file
    code, block, ordinal = file.indices.to_numpy(zero_copy_only=False).astype(np.int64), t["_block"].to_numpy(), t[row[1]].to_numpy()
    values = {f: _numbers(t[f]) for f in m.fields}
    order = np.lexsort([*[values[f] for f in reversed(m.fields)], ordinal, block, code])
    code, block, ordinal = code[order], block[order], ordinal[order]
    fresh = np.r_[True, (np.diff(code) != 0) | (np.diff(block) != 0)]
    seq, first = np.cumsum(fresh) - 1, np.flatnonzero(fresh)
    n, width = len(first), BLOCK + 2 * m.halo
    at = ordinal - block * BLOCK + m.halo
    one = np.r_[True, (np.diff(seq) != 0) | (np.diff(at) != 0)]  # of rows that claim one place, the first
    order, seq, at = order[one], seq[one], at[one]
    core = (at >= m.halo) & (at < m.halo + BLOCK)
    level, flags = np.full((len(m.fields), n, width), -1, np.int8), np.zeros((len(m.fields), n, width), np.uint8)
    for k, f in enumerate(m.fields):
        raw = values[f][order]
        grid = np.full((n, width), np.nan)
        grid[seq, at] = raw
        seen = ~np.isnan(grid)
        high, broken, lv = np.zeros((n, width), bool), np.zeros((n, width), bool), level[k]
        broken[seq, at] = t[f"_bad_{f}"].to_pandas().fillna(False).to_numpy(dtype=bool)[order]
        if f in m.leveled:
            limit = _numbers(t[f"_limit_{f}"])[order]
            with np.errstate(all="ignore"):
                above = np.abs(raw) > limit
                times = np.abs(raw) / limit * m.times
                b = np.where(above, len(LEVELS) + 1, np.where((limit > 0) & ~np.isnan(raw), np.digitize(times, LEVELS), -1))
            high[seq, at], lv[seq, at] = above, b
        follows = np.zeros((n, width), bool)
        if f in m.runs:
            follows[:, 1:] = grid[:, 1:] == grid[:, :-1]
        same = follows.copy()
        same[:, :-1] |= follows[:, 1:]
        exact = high | broken
        if f in m.runs:
            exact |= (run_lengths(follows) >= m.run) & seen
        flags[k] = SEEN * seen + SAME * same + BROKEN * broken + EXACT * exact
        flags[k][seq, at] |= np.where(core, CORE, 0).astype(np.uint8)
    return {"files": file.dictionary.take(pa.array(code[first])).to_pylist(), "blocks": block[first], "source": t["_source"].take(pa.array(order[np.flatnonzero(np.r_[True, np.diff(seq) != 0])])), "level": level, "flags": flags}


def _states(m: Model, level: np.ndarray, flags: np.ndarray, models: list[np.ndarray | None], count: bool) -> tuple[np.ndarray, np.ndarray | None]:
    """Probabilities (fields, sequences, places, states), and with count the expected counts (sequences, fields, stat_size).

    models has a source's sums for each sequence, None for the common model.
    """
    fields, n, width = level.shape
    known: dict[int, tuple] = {}
    fits = [known[id(s)] if id(s) in known else known.setdefault(id(s), fitted(m, s)) for s in models]
    normal, repeat, moves = (np.stack([f[i] for f in fits], axis=1).reshape(fields * n, *fits[0][i].shape[1:]) for i in range(3))
    lv, fl = level.reshape(fields * n, width).T, flags.reshape(fields * n, width).T
    core = ((fl & CORE) > 0).astype(float)
    p, moved = forward_backward(long_run(moves).T.copy(), np.ascontiguousarray(moves.transpose(1, 2, 0)), emissions(m, lv, fl, normal, repeat), core if count else None)
    sums = None
    if count:
        mine = p[:, 0] * core * ((fl & SEEN) > 0)
        by_level = [(mine * (lv == b)).sum(axis=0) for b in range(len(LEVELS) + 2)]
        same = (fl & SAME) > 0
        sums = np.stack([*by_level, (mine * same).sum(axis=0), (mine * ~same).sum(axis=0), *moved.reshape(16, -1)], axis=1).reshape(fields, n, -1).transpose(1, 0, 2)
    return p.reshape(width, 4, fields, n).transpose(2, 3, 0, 1), sums


def medians(rows: DataFrame, source: str, row: list[str], fields: list[str]) -> DataFrame:
    """(source, median_<field>...): exact medians of each source's non-null readings; repeated rows count once."""
    single = once(pick(rows, [*row, source, *fields]), row)
    cells = F.explode(F.array(*[F.struct(F.lit(f).alias("f"), F.col(f).cast("double").alias("v")) for f in fields]))
    counts = settle(ranks.value_counts(single.select(source, cells.alias("x")).select(source, "x.f", "x.v").where("not isnan(v)"), [source, "f"], "v"), "levels")
    got = ranks.quantiles(ranks.ranked(counts, [source, "f"], "v"), [source, "f"], "v", {"median": 0.5})
    return got.groupBy(source).agg(*[F.max(F.when(F.col("f") == f, F.col("median"))).alias(f"median_{f}") for f in fields])


def implausible(rows: DataFrame, model: Model, source: str, row: list[str], bounds: dict[str, object]) -> DataFrame:
    """(row..., field_name, state, probability, exact): readings that probably are not normal, with the likeliest other state,
    the probability of not being normal, and whether a hard bound, `times` medians or a run of `run` decides it alone.

    rows has the two row columns (file, ordinal), the source and the fields; bounds has a boolean column expression per
    field, true for readings that are impossible by themselves.
    """
    spark = rows.sparkSession
    ship(spark)
    level, _ = bounded(medians(rows, source, row, list(model.leveled)))
    o, block = F.col(row[1]), F.floor(F.col(row[1]) / BLOCK).cast("long")
    inside = F.pmod(o, F.lit(BLOCK))
    places = F.array_compact(F.array(block, F.when((inside < model.halo) & (block > 0), block - 1), F.when(inside >= BLOCK - model.halo, block + 1)))
    bad = [F.coalesce(bounds.get(f, F.lit(False)), F.lit(False)).alias(f"_bad_{f}") for f in model.fields]
    known = rows.where(F.col(row[0]).isNotNull() & o.isNotNull())
    limits = [(F.col(f"median_{f}") * model.times).alias(f"_limit_{f}") for f in model.leveled]
    plain = known.select(*row, F.col(source).alias("_source"), *[F.col(f).cast("double").alias(f) for f in model.fields], *bad, places.alias("_places"))
    ready = plain.join(level.withColumnRenamed(source, "_source"), "_source", "left").select(*row, "_source", F.explode("_places").alias("_block"), *model.fields, *[f"_bad_{f}" for f in model.fields], *limits)
    ready = ready.repartition(row[0], "_block").sortWithinPartitions(row[0], "_block")  # after the join, which keeps no order
    kinds = dict(rows.dtypes)

    def shown(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Per source of a chunk of blocks: its expected counts under the common model, and what its blocks show."""
        held, count = [], 0

        def flush(last: bool) -> Iterator[pa.RecordBatch]:
            nonlocal held, count
            t = pa.Table.from_batches(held)
            cut = len(t)
            if not last:  # the last block may go on in the next batch
                f, b = t[row[0]].combine_chunks(), t["_block"].to_numpy()
                code = f.dictionary_encode().combine_chunks().indices.to_numpy() if isinstance(f, pa.ChunkedArray) else f.dictionary_encode().indices.to_numpy()
                other = np.flatnonzero((code != code[-1]) | (b != b[-1]))
                cut = int(other[-1]) + 1 if len(other) else 0
            held, count = t.slice(cut).combine_chunks().to_batches() if cut < len(t) else [], len(t) - cut
            if cut:
                x = _shown(model, t.slice(0, cut), row)
                _, sums = _states(model, x["level"], x["flags"], [None] * len(x["blocks"]), True)
                own = x["source"].combine_chunks() if isinstance(x["source"], pa.ChunkedArray) else x["source"]
                code = own.dictionary_encode(null_encoding="encode").indices.to_numpy(zero_copy_only=False)
                for c in np.unique(code):
                    at = np.flatnonzero(code == c)
                    packed = pickle.dumps({"files": [x["files"][i] for i in at], "blocks": x["blocks"][at], "level": x["level"][:, at], "flags": x["flags"][:, at]}, protocol=5)
                    yield pa.RecordBatch.from_arrays([own.take(pa.array(at[:1])), pa.array([sums[at].sum(axis=0).ravel().tolist()], pa.list_(pa.float64())), pa.array([packed], pa.binary())], names=["source", "sums", "shown"])

        for batch in batches:
            if batch.num_rows:
                held.append(batch)
                count += batch.num_rows
                if count >= CHUNK_ROWS:
                    yield from flush(False)
        if held:
            yield from flush(True)

    first = settle(ready.mapInArrow(shown, f"source {kinds[source]}, sums array<double>, shown binary"), "shown")
    parts = first.where("source is not null").select("source", F.posexplode("sums").alias("i", "s")).groupBy("source", "i").agg(F.sum("s").alias("s"))
    models, _ = bounded(settle(parts.groupBy("source").agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "s"))), lambda x: x["s"]).alias("model")), "models"), 50_000)

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, sequences = [], 0

        def flush() -> pa.RecordBatch:
            x = {k: np.concatenate([h[k] for h, _ in held], axis=1) for k in ("level", "flags")}
            files = np.array([f for h, _ in held for f in h["files"]], dtype=object)
            blocks = np.concatenate([h["blocks"] for h, _ in held])
            p, _ = _states(model, x["level"], x["flags"], [s for h, s in held for _ in h["files"]], False)
            want = (x["flags"] & (SEEN | CORE)) == SEEN | CORE
            k, i, t = np.nonzero(want & (p[..., 0] < 0.5))
            chosen = p[k, i, t]
            columns = [pa.array(files[i].tolist(), out_file), pa.array(blocks[i] * BLOCK + t - model.halo).cast(out_ordinal), pa.array(np.array(model.fields, dtype=object)[k].tolist(), pa.string()), pa.array(np.array(STATES, dtype=object)[1 + chosen[:, 1:].argmax(axis=1)].tolist(), pa.string()), pa.array(1 - chosen[:, 0]), pa.array((x["flags"][k, i, t] & EXACT) > 0)]
            return pa.RecordBatch.from_arrays(columns, names=[*row, "field_name", "state", "probability", "exact"])

        for batch in batches:
            for raw, own in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                h = pickle.loads(raw)  # noqa: S301  (written by the pass above)
                held.append((h, None if own is None else np.array(own)))
                sequences += len(h["files"])
                if sequences >= CHUNK_ROWS // BLOCK:
                    yield flush()
                    held, sequences = [], 0
        if held:
            yield flush()

    from pyspark.sql.pandas.types import to_arrow_type

    out_file, out_ordinal = (to_arrow_type(rows.schema[r].dataType) for r in row)
    got = first.join(models.withColumnRenamed("source", "_s"), F.col("source") == F.col("_s"), "left").select("shown", "model")
    return got.mapInArrow(judged, f"`{row[0]}` {kinds[row[0]]}, `{row[1]}` {kinds[row[1]]}, field_name string, state string, probability double, exact boolean")
