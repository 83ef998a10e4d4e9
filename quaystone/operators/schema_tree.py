"""Nested schemas as trees, and the cheapest script that turns one into another.

A node has a name and a kind (`text`, `decimal`, `integer`, `boolean`, `null`, `object`, `array`). Children have no order, so the
distance is the constrained edit distance of unordered trees: the children of two nodes are matched at least cost, equal
and respelled names alike. What stays unmatched is deleted and added, unless moving is cheaper: the unmatched subtrees, and
then the nodes left within them, are matched at least cost with what came elsewhere. (With moves of any kind between any
nodes the least script is intractable; this is the least one among scripts of that form.)
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

ADD, DELETE, RENAME, MOVE, RETYPE = 1.0, 1.0, 0.5, 1.5, 0.25
RANK = {"null": 0, "integer": 1, "decimal": 2, "text": 3}
NESTED = ("object", "array")
Path = tuple[str, ...]


@dataclass(frozen=True)
class Node:
    name: str
    kind: str
    children: tuple[Node, ...] = field(default=())
    #: the type's own text, with the digits of decimals
    note: str = field(default="", compare=False)

    def size(self) -> int:
        return 1 + sum(c.size() for c in self.children)


def parse_schema(text: str | None) -> Node:
    """The tree of a schema in the form OBJECT<a: BIGINT, `b c`: OBJECT<...>, d: ARRAY<...>>."""
    at, text = 0, text or "OBJECT<>"

    def kind_of(word: str) -> str:
        word = word.split("(")[0].strip().upper()
        return {"VOID": "null", "BIGINT": "integer", "DOUBLE": "decimal", "FLOAT": "decimal", "DECIMAL": "decimal", "BOOLEAN": "boolean"}.get(word, "text")

    def value(name: str) -> Node:
        nonlocal at
        if text.startswith("OBJECT<", at):
            at += 7
            children = []
            while text[at] != ">":
                if text[at] == "`":
                    end = at + 1
                    while text[end] != "`" or text[end + 1 : end + 2] == "`":
                        end += 2 if text[end] == "`" else 1
                    key, at = text[at + 1 : end].replace("``", "`"), end + 1
                else:
                    end = text.index(":", at)
                    key, at = text[at:end], end
                at += 2  # ": "
                children.append(value(key))
                if text.startswith(", ", at):
                    at += 2
            at += 1
            return Node(name, "object", tuple(children))
        if text.startswith("ARRAY<", at):
            at += 6
            item = value("[]")
            at += 1
            return Node(name, "array", (item,))
        m = re.compile(r"[A-Za-z_ ]+(\([0-9, ]*\))?").match(text, at)
        at = m.end()
        return Node(name, kind_of(m[0]), (), m[0].strip().upper())

    return value("")


# -- spellings ------------------------------------------------------------------------------------------------------


def words(name: str) -> tuple[str, ...]:
    """The words of a field name: split at signs and at changes of case, in lower case."""
    spaced = re.sub(r"(?<=[a-z0-9])(?=[A-Z])|(?<=[A-Z])(?=[A-Z][a-z])", " ", name)
    return tuple(w.lower() for w in re.split(r"[^0-9A-Za-z]+", spaced) if w) or (name.lower(),)


def shortens(short: str, long: str) -> bool:
    """Whether a word of three letters or more stands for a longer one: its beginning up to a consonant, or its first
    letter and some of its consonants in order.

    A beginning that ends in a vowel is a word of its own more often than a cut (`date` in `datetime`).
    """
    if len(short) >= len(long) or len(short) < 3 or short[0] != long[0]:
        return False
    if long.startswith(short):
        return short[-1] not in "aeiou"
    rest = iter(long[1:])
    return not set(short[1:]) & set("aeiou") and all(c in rest for c in short[1:])


def same_field(a: str, b: str) -> bool:
    """Whether two names spell one field: case, signs, order of words and shortened words do not matter."""
    wa, wb = words(a), words(b)
    if "".join(wa) == "".join(wb) or sorted(wa) == sorted(wb):
        return True

    def near(x: str, y: str) -> bool:
        return x == y or shortens(x, y) or shortens(y, x)

    def match(left: list[str], right: list[str]) -> bool:
        if not left:
            return not right
        return any(near(left[0], r) and match(left[1:], right[:i] + right[i + 1 :]) for i, r in enumerate(right))

    def cut(run: str, parts: list[str]) -> bool:
        """Whether a name without any division can be divided so that it matches the parts."""
        if not parts:
            return not run
        return any(near(run[:k], r) and cut(run[k:], parts[:i] + parts[i + 1 :]) for i, r in enumerate(parts) for k in range(2, len(run) + 1))

    if len(wa) == len(wb):
        return match(list(wa), list(wb))
    one, more = sorted((wa, wb), key=len)
    return len(one) == 1 and len(more) <= 4 and cut(one[0], list(more))


# -- edit scripts ---------------------------------------------------------------------------------------------------


def _cheapest(costs: list[list[float]]) -> list[tuple[int, int]]:
    """Pairs of a least-cost matching; None costs forbid a pair. Successive shortest paths, as groups are small."""
    n, m = len(costs), len(costs[0]) if costs else 0
    of_left, of_right = [-1] * n, [-1] * m
    for start in range(n):
        # Bellman-Ford over alternating paths from `start`; leaving a side unmatched costs nothing more here
        dist, via = [0.0 if i == start else float("inf") for i in range(n)], [-1] * n
        best, end = 0.0, None
        for _ in range(n + 1):
            changed = False
            for i in range(n):
                if dist[i] == float("inf"):
                    continue
                for j in range(m):
                    if costs[i][j] is None or of_left[i] == j:
                        continue
                    d, k = dist[i] + costs[i][j], of_right[j]
                    if k < 0:
                        if d < best - 1e-9:
                            best, end = d, (i, j)
                    elif d - costs[k][j] < dist[k] - 1e-9 and k != start:
                        dist[k], via[k], changed = d - costs[k][j], i, True
            if not changed:
                break
        if end:
            i, j = end
            while i >= 0:
                old = of_left[i]
                of_left[i], of_right[j] = j, i
                i, j = (via[i], old) if i != start else (-1, -1)
    return [(i, j) for i, j in enumerate(of_left) if j >= 0]


def _pairs(gain: dict[tuple[int, int], float]) -> list[tuple[int, int]]:
    """The matching of greatest total gain; parts of the graph that share nothing are solved one by one."""
    of: dict[tuple[str, int], set] = {}
    for i, j in gain:
        both = of.setdefault(("l", i), {("l", i)}) | of.setdefault(("r", j), {("r", j)})
        for k in both:
            of[k] = both
    out = []
    for part in {id(v): v for v in of.values()}.values():
        left, right = sorted(i for s, i in part if s == "l"), sorted(j for s, j in part if s == "r")
        if len(left) == len(right) == 1:
            out.append((left[0], right[0]))
            continue
        costs = [[-gain[i, j] if (i, j) in gain else None for j in right] for i in left]
        out += [(left[i], right[j]) for i, j in _cheapest(costs)]
    return out


def within(path: Path, node: Node) -> list[tuple[Path, Node]]:
    """A node and all below it, with their paths."""
    return [(path, node)] + [x for c in node.children for x in within((*path, c.name), c)]


def edit_script(old: Node, new: Node, same=same_field) -> tuple[float, list[dict]]:
    """(cost, operations) of the cheapest script; an operation has op, path, and to_path or kinds where it needs them.

    `same(a, b)` says whether two unequal names may be one node renamed; unrelated names are deleted and added. Paths are
    tuples of names. A subtree that is deleted or added is listed node by node.
    """
    known: dict[tuple[str, str], bool] = {}

    def alike(a: str, b: str) -> bool:
        if a != b and (a, b) not in known:
            known[a, b] = same(a, b)
        return a == b or known[a, b]

    def aligned(a: Node, b: Node, path: Path) -> tuple[float, list[dict], list, list]:
        """Cost and operations of turning a into b, which stands at path, and what is left unmatched on either side."""
        cost, ops, gone, came = 0.0, [], [], []
        if a.kind != b.kind:
            cost += RETYPE
            ops.append({"op": "retype", "path": path[1], "from": a.kind, "to": b.kind})
        byname = {c.name: j for j, c in enumerate(b.children)}
        tries = {}
        for i, x in enumerate(a.children):
            for j, y in enumerate(b.children):
                if x.name == y.name or (x.name not in byname and alike(x.name, y.name)) or (x.children and y.children and alike(x.name, y.name)):
                    tries[i, j] = aligned(x, y, ((*path[0], x.name), (*path[1], y.name)))
        price = {(i, j): t[0] + RENAME * (a.children[i].name != b.children[j].name) + DELETE * sum(n.size() for _, n in t[2]) + ADD * sum(n.size() for _, n in t[3]) for (i, j), t in tries.items()}
        gain = {(i, j): DELETE * a.children[i].size() + ADD * b.children[j].size() - c for (i, j), c in price.items()}
        pairs = _pairs({k: g for k, g in gain.items() if g > 0})
        for i, j in pairs:
            x, y, t = a.children[i], b.children[j], tries[i, j]
            if x.name != y.name:
                cost += RENAME
                ops.append({"op": "rename", "path": (*path[0], x.name), "to_path": (*path[1], y.name)})
            cost, ops, gone, came = cost + t[0], ops + t[1], gone + t[2], came + t[3]
        left, right = {i for i, _ in pairs}, {j for _, j in pairs}
        gone += [((*path[0], x.name), x) for i, x in enumerate(a.children) if i not in left]
        came += [((*path[1], y.name), y) for j, y in enumerate(b.children) if j not in right]
        return cost, ops, gone, came

    cost, ops, gone, came = aligned(old, new, ((), ()))
    for whole in (True, False):  # first subtrees that move, then the single nodes left in the others
        if not whole:
            gone = [(p, Node(n.name, n.kind)) for p, x in gone for p, n in within(p, x)]
            came = [(p, Node(n.name, n.kind)) for p, x in came for p, n in within(p, x)]
        moves = {}
        for i, (p, x) in enumerate(gone):
            for j, (q, y) in enumerate(came):
                if p[:-1] != q[:-1] and bool(x.children) == whole and bool(y.children) == whole and (whole or (x.kind not in NESTED and y.kind not in NESTED)) and alike(x.name, y.name):
                    c, o, g, n = aligned(x, y, (p, q))
                    c += MOVE + RENAME * (x.name != y.name)
                    saved = DELETE * (x.size() - sum(z.size() for _, z in g)) + ADD * (y.size() - sum(z.size() for _, z in n)) - c
                    if saved > 0:
                        moves[i, j] = saved, c, o, g, n
        pairs = _pairs({k: m[0] for k, m in moves.items()})
        for i, j in pairs:
            _, c, o, g, n = moves[i, j]
            cost += c
            ops += [{"op": "move", "path": gone[i][0], "to_path": came[j][0]}, *o]
            gone, came = gone + g, came + n
        gone = [x for i, x in enumerate(gone) if i not in {i for i, _ in pairs}]
        came = [y for j, y in enumerate(came) if j not in {j for _, j in pairs}]
    cost += DELETE * len(gone) + ADD * len(came)
    ops += [{"op": "delete", "path": p} for p, _ in gone] + [{"op": "add", "path": p} for p, _ in came]
    order = {"rename": 0, "move": 1, "delete": 2, "add": 3, "retype": 4}
    return cost, sorted(ops, key=lambda o: (order[o["op"]], o["path"]))


def nodes(tree: Node, prefix: Path = ()) -> dict[Path, Node]:
    """Path and node of everything below the root."""
    return {p: n for c in tree.children for p, n in within((*prefix, c.name), c)}


def path_text(path: Path) -> str:
    """A path as text: a top-level name as it is, deeper ones joined by points, with the points in names escaped."""
    return path[0] if len(path) == 1 else ".".join(n.replace("\\", "\\\\").replace(".", "\\.") for n in path)


def variant_path(path: Path) -> tuple[str, bool]:
    """A path of object keys in the syntax of variant_get, and whether it is the whole path.

    That syntax has no escapes, so a key that holds both kinds of quotes cannot be named; the path then ends above it.
    """
    out = "$"
    for n in path:
        if '"' in n and "'" in n:
            return out, False
        out += f"['{n}']" if '"' in n else f'["{n}"]'
    return out, True
