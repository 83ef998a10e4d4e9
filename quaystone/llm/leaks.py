"""Passages of evaluation items inside training texts, whole or with words replaced.

Spaced seeds: a mask over SPAN consecutive words looks at some positions and ignores the others. Each text and item is
hashed at every position under each mask; equal hashes are hits. The masks look at every two of four groups of positions, so
that up to two replaced words in a span, wherever they stand, leave some mask untouched: such spans are always hit. Around a
hit both texts are compared word by word along the diagonal, as far as both have words, by the words' 64-bit hashes.

Items are the stated query set; items of equal words are one class and are told apart only in the result. Up to BLOCK_CHARS
characters of them go to the workers, where texts are met by sorted search without a shuffle. Beyond that masked hashes are
joined by shuffle: texts pass a sieve of the items' hashes first, a bitmap of fixed size, and only what passes is moved.

Defined results: null and blank texts and items have no words and no passages; equal passages of several items count for
each; repeated documents are reported each under its own id; items shorter than SPAN words cannot be found; items without
id are passed over; ids may be of any type.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quaystone.llm.words import words
from quaystone.runtime import pick, settle, ship

#: Words of a span, and how many of them may be replaced.
SPAN, REPLACED = 12, 2
#: Positions by their remainder of 4: a mask looks at two of the four groups.
MASKS = tuple(tuple(p for p in range(SPAN) if p % 4 in two) for two in combinations(range(4), 2))
#: Characters of item text up to which the items go to the workers.
BLOCK_CHARS = 8_000_000
#: Bits of the sieve beyond that: 16 MB.
SIEVE_BITS = 27
CACHE_WORDS, PAGE_WORDS, CELLS_AT_ONCE = 300_000, 400_000, 4_000_000
_hashes: dict[str, int] = {}


def word_hashes(ws: list[str]) -> np.ndarray:
    import xxhash

    known, out = _hashes, np.empty(len(ws), dtype=np.uint64)
    if len(known) > CACHE_WORDS:
        known.clear()
    digest = xxhash.xxh64_intdigest
    for i, w in enumerate(ws):
        h = known.get(w)
        if h is None:
            h = known[w] = digest(w)
        out[i] = h
    return out


def seeds(h: np.ndarray, mask: tuple[int, ...]) -> np.ndarray:
    """The masked hash at each position that SPAN words follow."""
    n = len(h) - SPAN + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for p in mask:
        out = (out ^ h[p : p + n]) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(29)
    return out


def _flat(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The numbers starts[i], starts[i] + 1, ... of each stretch, one after another."""
    return np.repeat(starts - np.r_[0, np.cumsum(lengths)[:-1]], lengths) + np.arange(int(lengths.sum()))


def judged(same: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(run, overlap, replaced) of each diagonal; same tells word by word what agrees, diagonal after diagonal.

    overlap is the longest stretch of overlapping or adjacent spans with at most REPLACED replaced words each, the one of
    fewest replaced words among equals; a diagonal without such a span has 0 in all three.
    """
    begin = np.r_[0, np.cumsum(lengths)[:-1]]
    owner = np.repeat(np.arange(len(lengths)), lengths)
    c = np.r_[0, np.cumsum(same)]
    at = np.arange(len(same))
    fits = at + SPAN <= (begin + lengths)[owner]
    good = at[fits]
    good = good[c[good + SPAN] - c[good] >= SPAN - REPLACED]
    run, overlap, replaced = (np.zeros(len(lengths), np.int64) for _ in range(3))
    if not len(good):
        return run, overlap, replaced
    who = owner[good]
    fresh = np.flatnonzero(np.r_[True, (np.diff(who) != 0) | (np.diff(good) > SPAN)])
    lo, hi, who = good[fresh], good[np.r_[fresh[1:] - 1, len(good) - 1]] + SPAN, who[fresh]
    wide = hi - lo
    lost = wide - (c[hi] - c[lo])
    order = np.lexsort((lost, -wide, who))
    first = order[np.r_[True, np.diff(who[order]) != 0]]
    overlap[who[first]], replaced[who[first]] = wide[first], lost[first]
    edge = np.r_[True, np.diff(owner) != 0]
    start = same & (edge | ~np.r_[False, same[:-1]])
    end = same & (np.r_[edge[1:], True] | ~np.r_[same[1:], False])
    a, b = np.flatnonzero(start), np.flatnonzero(end)
    np.maximum.at(run, owner[a], b - a + 1)
    run[overlap == 0] = 0
    return run, overlap, replaced


def best_of(text: np.ndarray, item: np.ndarray, run: np.ndarray, overlap: np.ndarray, replaced: np.ndarray) -> list[tuple[int, int, int, int, int]]:
    """(text, item, run, overlap, replaced) over all diagonals of a pair that have an overlap."""
    best: dict[tuple[int, int], list[int]] = {}
    for d, i, r, o, x in zip(text.tolist(), item.tolist(), run.tolist(), overlap.tolist(), replaced.tolist(), strict=True):
        if o:
            b = best.setdefault((d, i), [0, 0, 0])
            b[0] = max(b[0], r)
            if (o, -x) > (b[1], -b[2]):
                b[1:] = [o, x]
    return [(*k, *v) for k, v in sorted(best.items())]


class Index:
    """The masked hashes of a set of items, sorted, with where each stands; items of equal words share an entry."""

    def __init__(self, items: list[tuple[object, str | None]]):
        classes: dict[tuple[str, ...], list] = {}
        for i, t in items:
            classes.setdefault(tuple(words(t)), []).append(i)
        classes = {w: ids for w, ids in classes.items() if len(w) >= SPAN}
        self.ids = list(classes.values())
        hashes = [word_hashes(list(w)) for w in classes]
        self.lengths = np.array([len(h) for h in hashes], np.int64)
        self.words = np.concatenate(hashes) if hashes else np.empty(0, np.uint64)
        self.begin = np.r_[0, np.cumsum(self.lengths)[:-1]].astype(np.int64)
        self.tables, self.sieves = [], []
        for mask in MASKS:
            parts = [seeds(h, mask) for h in hashes]
            s = np.concatenate(parts) if parts else np.empty(0, np.uint64)
            who = np.repeat(np.arange(len(parts)), [len(p) for p in parts])
            at = np.concatenate([np.arange(len(p)) for p in parts]) if parts else np.empty(0, np.int64)
            order = np.argsort(s, kind="stable")
            self.tables.append((s[order], who[order].astype(np.int64), at[order].astype(np.int64)))
            sieve = np.zeros(1 << 20, bool)
            sieve[s & np.uint64(0xFFFFF)] = True
            self.sieves.append(sieve)

    def overlaps(self, h: np.ndarray, ends: np.ndarray) -> list[tuple[int, int, int, int, int]]:
        """(text, entry, run, overlap, replaced) of all pairs with an overlap; h holds many texts one after another, ends where each ends."""
        start, found = np.r_[0, ends[:-1]].astype(np.int64), []
        if not len(self.lengths):
            return []
        for m, mask in enumerate(MASKS):
            s, (keys, item, at) = seeds(h, mask), self.tables[m]
            near = np.flatnonzero(self.sieves[m][s & np.uint64(0xFFFFF)])
            text = np.searchsorted(ends, near, side="right")
            inside = near + SPAN <= ends[text] if len(near) else np.zeros(0, bool)
            near, text = near[inside], text[inside]
            lo, hi = np.searchsorted(keys, s[near], "left"), np.searchsorted(keys, s[near], "right")
            where = _flat(lo, hi - lo)
            found.append(np.stack([np.repeat(text, hi - lo), item[where], np.repeat(near - start[text], hi - lo) - at[where]]))
        hits = np.unique(np.concatenate(found, axis=1), axis=1)
        if not hits.size:
            return []
        first = np.maximum(0, -hits[2])  # of the item, the words that the text has places for
        last = np.minimum(self.lengths[hits[1]], (ends - start)[hits[0]] - hits[2])
        out, size = [], last - first
        cuts = np.searchsorted(np.cumsum(size), np.arange(CELLS_AT_ONCE, int(size.sum()) + CELLS_AT_ONCE, CELLS_AT_ONCE), side="left") + 1
        for a, b in zip(np.r_[0, cuts[:-1]], cuts, strict=True):
            d, i, g = hits[:, a:b]
            if not len(d):
                continue
            n, q = size[a:b], first[a:b]
            same = self.words[_flat(self.begin[i] + q, n)] == h[_flat(start[d] + g + q, n)]
            out.append((d, i, *judged(same, n)))
        return best_of(*(np.concatenate(x) for x in zip(*out, strict=True))) if out else []


_index: dict[str, Index] = {}


def _cached(name: str, items: Broadcast) -> Index:
    """The index of this worker process, which outlives a task."""
    if name not in _index:
        _index.clear()
        _index[name] = Index(items.value)
    return _index[name]


def pages(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, np.ndarray, np.ndarray, pa.DataType]]:
    """Keys, word hashes and ends of texts, many at a time."""
    keys, texts, size, kind = [], [], 0, None
    for b in batches:
        kind = b.column(0).type
        for d, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
            keys.append(d)
            texts.append(words(t))
            size += len(texts[-1])
            if size >= PAGE_WORDS:
                yield keys, word_hashes([w for t in texts for w in t]), np.cumsum([len(t) for t in texts]), kind
                keys, texts, size = [], [], 0
    if size:
        yield keys, word_hashes([w for t in texts for w in t]), np.cumsum([len(t) for t in texts]), kind


def _at_workers(docs: DataFrame, rows: DataFrame, kinds: tuple[str, str], names: tuple[str, str]) -> DataFrame:
    """Overlaps with items of at most BLOCK_CHARS characters, which every worker indexes once."""
    sent = docs.sparkSession.sparkContext.broadcast([(r["i"], r["t"]) for r in rows.collect()])
    name = uuid.uuid4().hex
    item_kind = rows.select("i").limit(0).toArrow().schema.field(0).type
    key, item_key = names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = _cached(name, sent)
        for keys, h, ends, kind in pages(batches):
            got = [(d, i, *rest) for d, k, *rest in index.overlaps(h, ends) for i in index.ids[k]]
            columns = [pa.array([keys[g[0]] for g in got], kind), pa.array([g[1] for g in got], item_kind), *[pa.array([g[x] for g in got], pa.int32()) for x in (2, 3, 4)]]
            yield pa.RecordBatch.from_arrays(columns, names=[key, item_key, "run", "overlap", "replaced"])

    return docs.mapInArrow(run, f"`{key}` {kinds[0]}, `{item_key}` {kinds[1]}, run int, overlap int, replaced int")


def _by_shuffle(docs: DataFrame, rows: DataFrame, kinds: tuple[str, str], names: tuple[str, str]) -> DataFrame:
    """Overlaps with items of any size, by a join of masked hashes behind a sieve."""
    spark, (key, item_key) = docs.sparkSession, names

    def classes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [words(t) for t in b.column(1).to_pylist()]
            hashes = [word_hashes(w).view(np.int64).tolist() for w in texts]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([" ".join(w) for w in texts]), pa.array(hashes, pa.list_(pa.int64()))], names=["i", "w", "hashes"])

    def item_seeds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for c, h in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                for m, mask in enumerate(MASKS):
                    s = seeds(np.array(h, np.int64).view(np.uint64), mask).view(np.int64)
                    yield pa.RecordBatch.from_arrays([pa.array([m] * len(s), pa.int32()), pa.array(s), pa.array([c] * len(s), pa.string()), pa.array(np.arange(len(s)))], names=["mask", "seed", "class", "q"])

    known = settle(rows.mapInArrow(classes, f"i {kinds[1]}, w string, hashes array<bigint>").where(F.size("hashes") >= SPAN).withColumn("class", F.md5("w")).drop("w"), "items")
    members = known.select("class", "i").distinct()
    single = known.groupBy("class").agg(F.first("hashes").alias("hashes"))
    own = settle(single.select("class", "hashes").mapInArrow(item_seeds, "mask int, seed bigint, class string, q bigint"), "seeds")
    low = F.col("seed").bitwiseAND((1 << SIEVE_BITS) - 1)
    bits = own.select(F.bitmap_bucket_number(low + 1).alias("b"), F.bitmap_bit_position(low + 1).alias("p")).groupBy("b").agg(F.bitmap_construct_agg("p").alias("bits"))
    sieve = np.zeros((1 << SIEVE_BITS) // 8, np.uint8)  # at most 2 ** SIEVE_BITS bits come to the driver
    for r in bits.collect():
        sieve[(r["b"] - 1) * 4096 : r["b"] * 4096] = np.frombuffer(bytes(r["bits"]), np.uint8)
    sent = spark.sparkContext.broadcast(sieve)

    def text_seeds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = sent.value
        for keys, h, ends, kind in pages(batches):
            start = np.r_[0, ends[:-1]]
            for m, mask in enumerate(MASKS):
                s = seeds(h, mask)
                at = (s & np.uint64((1 << SIEVE_BITS) - 1)).astype(np.int64)
                near = np.flatnonzero(held[at >> 3] >> (at & 7).astype(np.uint8) & 1)
                text = np.searchsorted(ends, near, side="right")
                inside = near + SPAN <= ends[text] if len(near) else np.zeros(0, bool)
                near, text = near[inside], text[inside]
                yield pa.RecordBatch.from_arrays([pa.array([keys[d] for d in text.tolist()], kind), pa.array([m] * len(near), pa.int32()), pa.array(s[near].view(np.int64)), pa.array((near - start[text]).astype(np.int64))], names=["d", "mask", "seed", "p"])

    def text_hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            hashes = [word_hashes(words(t)).view(np.int64).tolist() for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(hashes, pa.list_(pa.int64()))], names=["d", "text"])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n = pc.list_value_length(b.column(2)).to_numpy().astype(np.int64)
            run, overlap, replaced = judged(b.column(2).flatten().to_numpy() == b.column(3).flatten().to_numpy(), n) if len(n) else ([], [], [])
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), *[pa.array(np.asarray(x), pa.int32()) for x in (run, overlap, replaced)]], names=["d", "class", "run", "overlap", "replaced"])

    hits = docs.mapInArrow(text_seeds, f"d {kinds[0]}, mask int, seed bigint, p bigint").join(own, ["mask", "seed"]).select("d", "class", (F.col("p") - F.col("q")).alias("g")).distinct()
    hits = settle(hits, "hits")
    whole = docs.mapInArrow(text_hashes, f"d {kinds[0]}, text array<bigint>").join(hits.select("d").distinct(), "d", "left_semi")
    first = F.greatest(F.lit(0), -F.col("g"))  # of the item, the words that the text has places for
    size = F.least(F.size("hashes"), F.size("text") - F.col("g")) - first
    cut = lambda c, at: F.slice(c, (at + 1).cast("int"), size.cast("int"))
    pairs = hits.join(single, "class").join(whole.distinct(), "d").select("d", "class", cut("hashes", first).alias("mine"), cut("text", first + F.col("g")).alias("theirs"))
    got = pairs.mapInArrow(compare, f"d {kinds[0]}, class string, run int, overlap int, replaced int").where("overlap > 0").join(members, "class")
    return got.select(F.col("d").alias(key), F.col("i").alias(item_key), "run", "overlap", "replaced")


def overlaps(docs: DataFrame, key: str, text: str, items: DataFrame, item_key: str, item_text: str) -> DataFrame:
    """(key, item_key, run, overlap, replaced): for each text and item with a span of at most REPLACED replaced words, the longest
    exact run of words on its diagonals and the longest overlap."""
    ship(docs.sparkSession)
    kinds = (dict(docs.dtypes)[key], dict(items.dtypes)[item_key])
    rows = pick(items, [item_key, item_text], ["i", "t"]).where("i is not null and t is not null").distinct()
    chars = rows.agg(F.sum(F.length("t")).alias("n")).first()["n"] or 0
    way = _at_workers if chars <= BLOCK_CHARS else _by_shuffle
    out = way(pick(docs, [key, text]), rows, kinds, (key, item_key))
    return out.groupBy(key, item_key).agg(F.max("run").alias("run"), F.max(F.struct("overlap", (-F.col("replaced")).alias("kept"))).alias("o")).select(key, item_key, "run", "o.overlap", (-F.col("o.kept")).alias("replaced"))


def leaks(docs: DataFrame, key: str, text: str, items: DataFrame, item_key: str, item_text: str) -> DataFrame:
    """(key, item_key): texts that hold at least SPAN consecutive words of an item."""
    return overlaps(docs, key, text, items, item_key, item_text).where(F.col("run") >= SPAN).select(key, item_key)
