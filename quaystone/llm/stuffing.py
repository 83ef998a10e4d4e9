"""Pages of repeated keywords, links and tags instead of sentences.

A page is read as units: lines, and sentences within lines. A suffix automaton over the page's characters (words parted by
single spaces, units by marks of their own) finds every maximal substring that occurs again, and gives the share of each
unit's characters that such substrings of some length cover. A unit has clause structure if words that tie clauses together
stand in it, or if it is closed like a sentence and repeats little; a unit without it is filler when it is a link, a list
of short items (repeated or not), a long run of words that nothing ties, one of many short lines on end, made of the page's few
stuffed words and repeated, or mostly covered by repeats. Tables, logs and program text are no filler. A page is reported when
more than half of its words stand in filler.

More coverage never makes a unit less of a filler. So a page whose filler would not reach the bar even if repeats covered all
of it is settled without its automaton when only reported pages are asked for.

Defined results: null, empty and blank texts are not reported; a text without any word or link has a share of 0; the share
is of the whole text, however long; repeated documents are each reported.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quaystone.runtime import pick, ship

# Words that tie clauses together, by language.
GRAMMAR = {
    "en": "the of and to in is was were be been are it its that this those these for on with as by at from not no nor or but if than then so because while when where who whoever which what how did does do can could may might must should would will has had have a an i you he she they we our his her their there here still also after before between until every each another any about into an whose shall yet",
    "es": "el la los las un una de del al que y o no se en por para con sin su sus es son fue era ha han había porque como más pero cuando donde quién cada esta este ya hay lo le durante entre antes hasta",
    "fr": "le la les un une des du de et ou que qui ne pas en dans par pour sur avec sans son sa ses est sont était ont avait parce comme plus mais quand où chaque cette ce il elle on nous au aux l d n s c j qu à a été pendant leur avant puis déjà y",
    "de": "der die das den dem des ein eine einen einem einer und oder nicht kein keine in im am an auf aus bei mit nach von vor zu zum zur ist sind war waren hat haben wird wurde wurden werden weil als wie wer was wenn aber auch noch nur sich es er sie wir man jede jeder für über ohne",
    "it": "il lo gli della delle dei nel nella che non è sono per con una uno si ha hanno questo questa perché quando",
    "pt": "o os as da das do dos em na no não é são para com uma um se foi tem que quando porque",
    "nl": "het een van en niet dat die op te aan met voor zijn was werd wordt ook maar als er om",
}
TIES = frozenset(w for text in GRAMMAR.values() for w in text.split())
LINK = re.compile(r"""(?:https?:|\bhref=["']?)?//[^\s"'<>)\]]+|\bwww\.[^\s"'<>)\]]+|\b[a-z0-9-]+(?:\.[a-z0-9-]+)*\.[a-z]{2,}/[^\s"'<>)\]]*|\b[a-z0-9-]+(?:\.[a-z0-9-]+)*\.[a-z]{3,}\b(?!\()|\b[a-z0-9-]+\.[a-z0-9-]+\.[a-z]{2}\b""")
MAYBE_LINK = re.compile(r"//|www\.|[a-z0-9]\.[a-z]{2}")
TAG = re.compile(r"<[^<>]*>")
BLOCK = re.compile(r"</?(?:address|article|aside|blockquote|br|d[dlt]|div|footer|form|h[1-6r]|header|li|main|nav|ol|option|p|pre|section|t[dhr]|table|ul)\b", re.I)
PART = re.compile(r"[A-ZÀ-Þ]?[a-zß-ÿ]+|[0-9]+[a-z]?(?![a-z])|[A-ZÀ-Þ]+(?![a-zß-ÿ])|[^\W_]+")
#: Repeats of so many characters count, spaces at either end included; of scripts without spaces (kana, Han, Thai, Lao, Burmese,
#: Khmer) fewer.
UNSPACED = re.compile("[\u3040-\u30ff\u3400-\u9fff\uf900-\ufaff\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff]")
LEAST, LEAST_UNSPACED = 5, 4
#: So many short lines on end are filler without repeats, and so many words of one unit that nothing ties or closes.
MANY, LOOSE = 12, 16
NUMERIC = re.compile(r"[$€£+-]?\d[\d.,:/%hT-]*[AaPp]?[Mm]?")
CODE = re.compile(r"[=(){}\[\]<>]")
TOKEN = re.compile(r"[^\W_]+")
ITEMS = re.compile(r"\s*(?:[|,;•·»]|\s/\s|\s-\s)\s*")
SENTENCE = re.compile(r"(?<=[.!?…。！？])[\"'”’)\]]*\s+")
ENDS = frozenset(".!?…。！？")


def repeats(symbols: list[int], least: list[int] | None = None) -> bytearray:
    """1 at each position of a sequence that lies in a substring which occurs at least twice.

    least: by position, the length from which a repeat that ends there counts.

    The suffix automaton's states, visited from long to short, know how often their substrings occur; feeding the sequence
    again, the longest suffix at each position that occurs twice or more is a maximal repeat and covers its positions.
    """
    n = len(symbols)
    step: list[dict[int, int]] = [{}]
    link, length, count = [-1], [0], [0]
    last = 0
    for c in symbols:
        cur = len(step)
        step.append({})
        length.append(length[last] + 1)
        link.append(0)
        count.append(1)
        p = last
        while p >= 0 and c not in step[p]:
            step[p][c] = cur
            p = link[p]
        if p >= 0:
            q = step[p][c]
            if length[p] + 1 == length[q]:
                link[cur] = q
            else:
                clone = len(step)
                step.append(step[q].copy())
                length.append(length[p] + 1)
                link.append(link[q])
                count.append(0)
                while p >= 0 and step[p].get(c) == q:
                    step[p][c] = clone
                    p = link[p]
                link[q] = link[cur] = clone
        last = cur
    for s in sorted(range(1, len(step)), key=length.__getitem__, reverse=True):
        if link[s] > 0:
            count[link[s]] += count[s]
    covered = bytearray(n)
    s, reach = 0, n
    ends = []
    for c in symbols:
        s = step[s][c]
        t = s
        while t > 0 and count[t] < 2:
            t = link[t]
        ends.append(length[t] if t > 0 and (least is None or length[t] >= least[len(ends)]) else 0)
    for i in range(n - 1, -1, -1):  # the nearest start to the left that some repeat ending here or later reaches
        if ends[i]:
            reach = min(reach, i - ends[i] + 1)
        if i >= reach:
            covered[i] = 1
        else:
            reach = n
    return covered


def _parts(text: str) -> list[str]:
    out = []
    for w in TOKEN.findall(text):
        if w.islower() or w.isdigit():
            out.append(w)
        elif w.isascii() and w.isalpha() and w[1:].islower():  # a capitalised word is one part
            out.append(w.lower())
        else:
            out += [p.lower() for p in PART.findall(w)]
    return out


def _closed(text: str) -> bool:
    """Whether a unit ends like a sentence, quotes and brackets aside."""
    return text.rstrip().rstrip("\"'”’)]")[-1:] in ENDS


@dataclass(slots=True)
class Unit:
    text: str
    line: int
    links: int
    parts: list[str]
    kept: bool  # of a table, a log or program text
    span: int  # characters of its words
    covered: int = 0  # of these, in repeats


def _rows_of_tables(lines: list[str]) -> set[int]:
    """Lines of tables and logs: three or more on end of which four in five begin or end with a number that does not just count them."""
    first, last = [], []
    for x in lines:
        cells = [c for c in re.split(r"[\s|]+", x) if c]
        first.append(bool(cells) and len(cells) > 1 and bool(NUMERIC.fullmatch(cells[0])) and not re.fullmatch(r"\d+[.):]?", cells[0]))
        last.append(bool(cells) and len(cells) > 1 and bool(NUMERIC.fullmatch(cells[-1])))
    out: set[int] = set()
    for marks in (first, last):
        runs, at = [], 0
        while at < len(marks):
            if marks[at]:
                end, misses = at + 1, 0
                while end < len(marks) and (marks[end] or (misses + 1) * 5 <= end - at + 1):
                    misses += not marks[end]
                    end += 1
                runs.append((at, end))
                at = end
            else:
                at += 1
        for lo, hi in runs:
            if hi - lo >= 3:
                out.update(range(lo, hi))
    return out


def _units(text: str) -> list[Unit]:
    # links become a mark of their own; tags end units, so that the items of a marked-up list stand apart
    shown = LINK.sub(" \x00 ", text) if MAYBE_LINK.search(text) else text
    shown = TAG.sub(lambda m: " \x00 " if "\x00" in m[0] else "\n" if BLOCK.match(m[0]) else " ", shown) if "<" in shown else shown
    lines = [x for x in shown.replace("\r", "\n").split("\n") if x.strip()]
    tables = _rows_of_tables(lines) if len(lines) >= 3 else ()
    units: list[Unit] = []
    for k, line in enumerate(lines):
        code = k in tables or ("\x00" not in line and any(c in line for c in "={}") and len(CODE.findall(line)) >= 3)
        for u in SENTENCE.split(line):
            parts, links = _parts(u), u.count("\x00")
            if parts or links:
                units.append(Unit(u, k, links, parts, code, sum(map(len, parts))))
    return units


def _run(u: Unit) -> tuple[str, list[int]]:
    """A unit's words between single spaces, and the length from which a repeat that ends at each character counts."""
    run = f" {' '.join(u.parts)} " if u.parts else ""
    if run.isascii():
        return run, [LEAST] * len(run)
    return run, [LEAST_UNSPACED if UNSPACED.match(c) or (c == " " and i and UNSPACED.match(run[i - 1])) else LEAST for i, c in enumerate(run)]


def _cover(units: list[Unit]) -> None:
    """Count the characters of each unit that lie in repeats of the page, by its suffix automaton."""
    symbols: list[int] = []
    least: list[int] = []
    ends: list[int] = []
    for u in units:
        run, own = _run(u)
        symbols += map(ord, run)
        symbols.append(-len(symbols) - 1)  # a mark that occurs once parts the units
        least += [*own, LEAST]
        ends.append(len(symbols))
    covered = repeats(symbols, least)
    for u, a, b in zip(units, [0, *ends], ends, strict=False):
        u.covered = sum(c for x, c in zip(symbols[a : b - 1], covered[a : b - 1], strict=True) if x != 32)


def _cover_by_windows(units: list[Unit]) -> None:
    """The same counts: what lies in a repeat of some length lies in a window of that length that occurs again. It tells
    nothing of the repeats themselves, and serves pages that are settled without them."""
    runs = [_run(u) for u in units]
    often = Counter(run[e + 1 - n : e + 1] for run, least in runs for e, n in enumerate(least) if e + 1 >= n)
    for u, (run, least) in zip(units, runs, strict=True):
        upto = u.covered = 0
        for e, n in enumerate(least):
            if e + 1 >= n and often[run[e + 1 - n : e + 1]] > 1:
                begin = max(upto, e + 1 - n)
                u.covered += e + 1 - begin - run.count(" ", begin, e + 1)
                upto = e + 1


def _share(units: list[Unit], all_covered: bool = False) -> tuple[float, float]:
    """(share of words in filler, share of characters covered), or the former as if repeats covered everything."""
    often = Counter(p for u in units for p in u.parts)
    total = sum(often.values())
    stuffed = {p for p, c in often.items() if c >= 4 and c >= 0.02 * total}
    judged = []  # words, filler or not (None: a short line, judged with its neighbours), characters, covered ones, grammar words
    for u in units:
        parts, links, n = u.parts, u.links, len(u.parts)
        span, rep = u.span, u.span if all_covered else u.covered
        size = (n + sum(len(p) if UNSPACED.search(p) else 1 for p in parts)) / 2 if not u.text.isascii() else n  # two characters of a script without spaces count as a word
        tied = [p for p in parts if p in TIES]
        ties, bound = set(tied), len(tied)
        closed, distinct = _closed(u.text), len(set(parts))
        items = [i for i in ITEMS.split(u.text) if i.strip()] if sum(map(u.text.count, "|,;•·»/-")) >= 3 else ()
        listed = len(items) >= 4 and n <= 4.5 * len(items) and not (closed and len(ties) >= 2 and bound >= 0.15 * n)
        linked = links > 0 and n <= 8 * links and len(ties) < 3
        few = n > 0 and sum(p in stuffed for p in parts) >= 0.85 * n and not (n >= 6 and distinct >= 0.7 * n and len(ties) >= 2)
        same = n >= 8 and distinct <= 0.4 * n and rep >= 0.8 * span
        clause = (bound >= 1 and bound >= 0.12 * n and n >= 3) or (closed and n >= 5 and rep < 0.5 * span and distinct >= 0.8 * n)
        # unlike items: grammar words part them from a sentence, a full stop does not if they are many
        tags = listed and size <= 4.5 * len(items) and not (bound >= 1 and bound >= 0.12 * n) and (not closed or (len(items) >= 8 and size <= 3 * len(items)))
        loose = n >= LOOSE and bound < 0.05 * n and not closed and size == n
        is_filler = linked or (not u.kept and (same or tags or loose or ((listed or few or not clause) and bool(rep >= 0.35 * span or links))))
        short = not is_filler and not u.kept and not closed and 0 < n <= 4 and not links
        judged.append((n + links, None if short else is_filler, span, rep, bound if size <= 4 else n))
    words = filler = chars = hit = 0
    run: list[tuple] = []
    for n, is_filler, span, rep, bound in [*judged, (0, False, 0, 0, 0)]:
        words, chars, hit = words + n, chars + span, hit + rep
        if is_filler is None or (is_filler and n <= 4):
            run.append((n, is_filler, span, rep, bound))
            continue
        whole = (len(run) >= 4 and sum(r[3] for r in run) >= 0.35 * sum(r[2] for r in run)) or (len(run) >= MANY and sum(r[4] for r in run) < 0.12 * sum(r[0] for r in run))
        filler += sum(r[0] for r in run if whole or r[1]) + (n if is_filler else 0)
        run = []
    return filler / words if words else 0.0, hit / chars if chars else 0.0


def filler_share(text: str | None, bar: float = 0.5, coverage: bool = True) -> tuple[float, float | None]:
    """(share of words in filler, share of characters covered by repeats) of one text.

    A text whose share cannot exceed the bar whatever repeats needs no automaton: its coverage is counted by windows, or left
    out with an upper bound of its share where `coverage` is not wanted.
    """
    if not text or not text.strip():
        return 0.0, 0.0
    units = _units(text)
    if (most := _share(units, True)[0]) > bar:
        _cover(units)
    elif coverage:
        _cover_by_windows(units)
    else:
        return most, None
    return _share(units)


def filler_shares(docs: DataFrame, key: str, text: str, bar: float = 0.5, coverage: bool = True) -> DataFrame:
    """(key, filler, covered) of each text, as filler_share has them."""
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = [filler_share(t, bar, coverage) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([x for x, _ in got], pa.float64()), pa.array([y for _, y in got], pa.float64())], names=[key, "filler", "covered"])

    return pick(docs, [key, text]).mapInArrow(run, f"`{key}` {dict(docs.dtypes)[key]}, filler double, covered double")


def stuffed_pages(docs: DataFrame, key: str, text: str, share: float = 0.5) -> DataFrame:
    """(key) of the texts of which more than `share` of the words stand in filler."""
    return filler_shares(docs, key, text, share, False).where(F.col("filler") > share).select(key).distinct()
