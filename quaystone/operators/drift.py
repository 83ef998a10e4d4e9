"""Schemas that drift between the files of a feed: one tree per file, edit scripts between files, one consistent table.

The tree of a file is merged from its payloads by an aggregate with partial results, so a file of any size moves one small
schema per task. Files are chained by a window over file metadata alone. Trees are parsed once per distinct schema and
scripts found once per distinct pair of schemas, however many files share them.

Fields are classes of paths: the renames and moves of all scripts link paths, and so do spellings across feeds and gaps, but
two paths that stand in one schema are never one field. From the classes each distinct schema gets its projection, the path
of each column in it, and every row is read through the projection of its file.

Defined results: a payload that is null, cut off, no object, or repeats a key is passed over by changes and scripts and listed
with its reason by `rejected`; a key with null counts as present; whole numbers beyond 64 bits count as decimal and keep
their digits in the table; mixed kinds of a field are text; a feed's first file has no changes; files of equal time are
ordered by id; rows delivered twice come once; an empty table gives no changes. A top-level name with a point is one name.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quaystone.operators.schema_tree import NESTED, RANK, Node, edit_script, nodes, parse_schema, path_text, same_field, variant_path, words
from quaystone.runtime import bounded, pick, settle, ship

#: Fields that become columns of the consistent table, those of most schemas first; the others are kept in a map.
MOST_COLUMNS = 2_000
#: Paths that a group of blocks has about, in which the classes of spellings are found; a matter of speed alone.
ONE_BLOCK = 2_000
#: Digits that a double holds for certain.
SAFE_DIGITS = 15


def _parsed(records: DataFrame, columns: list[str], payload: str) -> DataFrame:
    """columns, and the payload as text and as `v`."""
    labels = [f"_k{i}" for i in range(len(columns))]
    return pick(records, [*columns, payload], [*labels, "_payload"]).select(*[F.col(x).alias(c) for x, c in zip(labels, columns, strict=True)], "_payload", F.expr("try_parse_json(_payload)").alias("v"))


IS_OBJECT = "schema_of_variant(v) like 'OBJECT<%'"


def file_schemas(records: DataFrame, file: str, payload: str) -> DataFrame:
    """(file, schema, long_numbers): the merged schema of each file's payloads that parse, null where none does, and whether
    any of its numbers may have more digits than a double holds; one pass over the rows."""
    v = _parsed(records, [file], payload)
    objects = F.expr(f"schema_of_variant_agg(case when {IS_OBJECT} then v end)")
    far = F.coalesce(F.max(F.col("_payload").rlike(f"[0-9][0-9.]{{{SAFE_DIGITS},}}")), F.lit(False))
    return v.groupBy(file).agg(objects.alias("schema"), far.alias("long_numbers")).withColumn("schema", F.when(F.col("schema").startswith("OBJECT<"), F.col("schema")))


def rejected(records: DataFrame, keys: list[str], payload: str) -> DataFrame:
    """(keys..., reason) of the rows whose payload is no JSON object: `null`, `no_json` (cut off, or a key repeated) or `no_object`."""
    v = _parsed(records, keys, payload)
    reason = F.when(F.col("_payload").isNull(), "null").when(F.col("v").isNull(), "no_json").when(~F.expr(IS_OBJECT), "no_object")
    return v.select(*keys, reason.alias("reason")).where("reason is not null").distinct()


def chained(files: DataFrame, feed: list[str], at: str, file: str, columns: list[str]) -> DataFrame:
    """files with `previous_file` and previous_<column> of the file of the same feed that came next before."""
    w = Window.partitionBy(*feed).orderBy(at, file)
    return files.select("*", F.lag(file).over(w).alias("previous_file"), F.row_number().over(w).alias("position"), *[F.lag(c).over(w).alias(f"previous_{c}") for c in columns])


def shape_text(schema: Column) -> Column:
    """A schema without the digits of its decimals; files of one such text share their tree and have its MD5 as their shape."""
    return F.coalesce(F.regexp_replace(schema, r": DECIMAL\(\d+, ?\d+\)", ": DECIMAL"), F.lit("OBJECT<>"))


def pair_scripts(pairs: DataFrame) -> DataFrame:
    """(previous_shape, shape, op, path, to_path, from_kind, to_kind, cost) of each distinct pair of unlike (previous_text, text);
    paths are arrays."""
    ship(pairs.sparkSession)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for old, new in zip(b["previous_text"], b["text"], strict=True):
                cost, ops = edit_script(parse_schema(old), parse_schema(new))
                rows += [(_md5(old), _md5(new), o["op"], list(o["path"]), list(o["to_path"]) if "to_path" in o else None, o.get("from"), o.get("to"), cost) for o in ops]
            yield pd.DataFrame(rows, columns=["previous_shape", "shape", "op", "path", "to_path", "from_kind", "to_kind", "cost"])

    unlike = pairs.where("previous_text <> text").select("previous_text", "text").distinct()
    return unlike.mapInPandas(run, "previous_shape string, shape string, op string, path array<string>, to_path array<string>, from_kind string, to_kind string, cost double")


def _md5(text: str) -> str:
    return hashlib.md5(text.encode(), usedforsecurity=False).hexdigest()


def _as_text(path: str) -> Column:
    """A path array as schema_tree.path_text has it."""
    escaped = F.transform(F.col(path), lambda n: F.replace(F.replace(n, F.lit("\\"), F.lit("\\\\")), F.lit("."), F.lit("\\.")))
    return F.when(F.size(path) == 1, F.col(path)[0]).when(F.col(path).isNotNull(), F.array_join(escaped, "."))


def edit_scripts(chain: DataFrame, file: str) -> DataFrame:
    """(file, op, path, to_path, from_kind, to_kind, cost): the cheapest script from the file before to each file.

    chain has file, previous_file, schema and previous_schema, one row per file.
    """
    pairs = chain.where("previous_file is not null").select(file, shape_text(F.col("previous_schema")).alias("previous_text"), shape_text(F.col("schema")).alias("text"))
    side, _ = bounded(settle(pair_scripts(pairs), "scripts"))
    return pairs.select(file, F.md5("previous_text").alias("previous_shape"), F.md5("text").alias("shape")).join(side, ["previous_shape", "shape"]).select(file, "op", _as_text("path").alias("path"), _as_text("to_path").alias("to_path"), "from_kind", "to_kind", "cost")


def shape_nodes(shapes: DataFrame) -> DataFrame:
    """(shape, path, kind, leaf) of every node of each distinct text's tree; what lies within arrays is left out."""
    ship(shapes.sparkSession)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = [(_md5(s), list(p), n.kind, is_leaf(n)) for s in b["text"] for p, n in nodes(parse_schema(s)).items() if "[]" not in p]
            yield pd.DataFrame(rows, columns=["shape", "path", "kind", "leaf"])

    return shapes.select("text").distinct().mapInPandas(run, "shape string, path array<string>, kind string, leaf boolean")


def is_leaf(n: Node) -> bool:
    """Whether a node is a column of its own: anything but an object with members."""
    return n.kind != "object" or not n.children


def _initials(name: str) -> str:
    return "".join(sorted(w[:1] for w in words(name)))


def _joined(edges: DataFrame) -> DataFrame:
    """(node, label): the connected component of every node of the edges (a, b), named by its least node.

    Each partition leaves a tree of every part it sees, and one task joins those; it holds the nodes, not the edges.
    """

    def trees(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        up: dict[str, str] = {}

        def head(x: str) -> str:
            while up.setdefault(x, x) != x:
                up[x] = x = up[up[x]]
            return x

        for b in batches:
            for x, y in zip(b["a"], b["b"], strict=True):
                x, y = sorted((head(x), head(y)))
                up[y] = x
        yield pd.DataFrame([(x, head(x)) for x in list(up)], columns=["a", "b"])

    return edges.mapInPandas(trees, "a string, b string").repartition(1).mapInPandas(trees, "a string, b string").toDF("node", "label")


def _name_labels(names: DataFrame) -> DataFrame:
    """(name, label): names that same_field finds alike, or a chain of such names, have one label; `name` is distinct.

    A name hangs on its letters and on its sorted words, which settles all but shortened words. For those, one name of each
    set of words is compared with others of equal initials, which no shortening changes, and a lone word with the two to
    four words of which one begins as it does and all begin with letters of it.
    """

    def forms(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for n in b["name"]:
                ws = words(n)
                rows.append((n, "l" + "".join(ws), "s" + " ".join(sorted(ws)), len(ws), _initials(n), list({w[:1] for w in ws})))
            yield pd.DataFrame(rows, columns=["name", "letters", "sorted", "parts", "initials", "starts"])

    def alike(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield b[[same_field(x, y) for x, y in zip(b["a"], b["b"], strict=True)]]

    names = settle(names.mapInPandas(forms, "name string, letters string, sorted string, parts int, initials string, starts array<string>"), "names")
    kinds = names.groupBy("sorted", "parts", "initials").agg(F.min("name").alias("name"), F.array_distinct(F.flatten(F.collect_set("starts"))).alias("starts"))
    keys = F.when(F.col("parts").between(2, 4), F.array_union(F.array("initials"), "starts")).otherwise(F.array("initials"))
    one = kinds.select(F.col("name").alias("a"), F.col("parts").alias("a_parts"), F.substring("sorted", 2, 2**31 - 1).alias("run"), "initials")
    other = kinds.select(F.col("name").alias("b"), F.col("parts").alias("b_parts"), "starts", F.explode(keys).alias("initials"))
    pairs = one.join(other, "initials").where("(a_parts = b_parts and a < b) or (a_parts < b_parts and forall(starts, s -> contains(run, s)))")
    short = pairs.select("a", "b").repartition(4 * names.sparkSession.sparkContext.defaultParallelism, "a", "b").mapInPandas(alike, "a string, b string")
    node = F.concat(F.lit("n"), "name")
    own = names.select(node.alias("a"), F.explode(F.array("letters", "sorted")).alias("b"))
    edges = own.unionByName(short.select(*[F.concat(F.lit("n"), x).alias(x) for x in ("a", "b")]))
    return names.select("name", node.alias("node")).join(_joined(edges), "node").select("name", "label")


def _blocks(paths: DataFrame, links: DataFrame) -> DataFrame:
    """(path, block): paths that any chain of links and of spellings connects share a block; `path` is distinct.

    Only paths whose names have the same labels one by one can be spellings of one field, so these labels are a path's key,
    and links connect keys. No union of `field_classes` reaches beyond a block.
    """
    parts = paths.select("path", F.posexplode("path").alias("at", "name"))
    labels, _ = bounded(settle(_name_labels(parts.select("name").distinct()), "labels"))
    named = parts.join(labels, "name").groupBy("path").agg(F.array_sort(F.collect_list(F.struct("at", "label"))).alias("names"))
    keys = settle(named.select("path", F.to_json("names.label").alias("key")), "keys")
    ends = links.join(keys.select("path", F.col("key").alias("a")), "path").join(keys.select(F.col("path").alias("to_path"), F.col("key").alias("b")), "to_path")
    side, _ = bounded(settle(_joined(ends.select("a", "b").where("a <> b").distinct()), "blocks"))
    return keys.join(side.withColumnRenamed("node", "key"), "key", "left").select("path", F.coalesce("label", "key").alias("block"))


def field_classes(paths: DataFrame, links: DataFrame) -> DataFrame:
    """(path, field): one field for all spellings of a path; paths has (path, shape), links (path, to_path) of the scripts.

    Two paths of one shape are never one field. Links of the scripts go first, then names of equal letters or words, then
    shortened ones. A vocabulary beyond ONE_BLOCK paths is cut into groups of whole blocks of `_blocks`: all paths that could ever
    be united are in one group and stand in the same order there, so the classes are the same for any number of groups.
    """
    ship(paths.sparkSession)
    left = paths.groupBy("path").agg(F.collect_set(F.xxhash64("shape")).alias("shapes"))
    right = links.distinct()
    groups = -(-paths.select("path").distinct().count() // ONE_BLOCK)
    if groups <= 1:
        left, right = left.withColumn("group", F.lit(0)), right.withColumn("link_group", F.lit(0))
    else:
        of_path = settle(_blocks(left.select("path"), right).select("path", F.pmod(F.xxhash64("block"), F.lit(groups)).alias("group")), "groups")
        left, right = left.join(of_path, "path"), right.join(of_path.withColumnRenamed("group", "link_group"), "path")

    def group(p: pd.DataFrame, k: pd.DataFrame) -> pd.DataFrame:
        at = {tuple(x): set(s) for x, s in zip(p["path"], p["shapes"], strict=True)}
        order = sorted(at, key=lambda x: (-len(at[x]), x))
        place = {x: i for i, x in enumerate(order)}
        of, members = {x: x for x in order}, {x: [x] for x in order}

        def unite(x: tuple, y: tuple) -> None:
            a, b = sorted((of[x], of[y]), key=place.get)
            if a != b and not at[a] & at[b]:
                at[a] |= at.pop(b)
                for m in members[b]:
                    of[m] = a
                members[a] += members.pop(b)

        for x, y in sorted((tuple(x), tuple(y)) for x, y in zip(k["from_path"], k["to_path"], strict=True)):
            if x in of and y in of:
                unite(x, y)
        for form in (lambda n: "".join(words(n)), lambda n: " ".join(sorted(words(n)))):
            first: dict[tuple, tuple] = {}
            for x in order:
                unite(first.setdefault(tuple(map(form, x)), x), x)
        heads = [(x, _initials(x[-1])) for x in order if x in members]
        for i, (x, a) in enumerate(heads):
            for y, b in heads[i + 1 :]:
                if (a == b or (len(a) == 1 and a in b) or (len(b) == 1 and b in a)) and len(x) == len(y) and of[x] != of[y] and all(map(same_field, x, y)):
                    unite(x, y)
        return pd.DataFrame({"path": [list(x) for x in order], "field": [list(of[x]) for x in order]})

    left, right = left.select("group", "path", "shapes"), right.select("link_group", F.col("path").alias("from_path"), "to_path")
    return left.groupBy("group").cogroup(right.groupBy("link_group")).applyInPandas(group, "path array<string>, field array<string>")


class Drift:
    """What the files of a table of payloads have in common: chain, scripts, nodes of distinct shapes, field classes."""

    def __init__(self, records: DataFrame, files: DataFrame, file: str, payload: str, feed: list[str], at: str):
        self.file, self.feed = file, feed
        known = pick(files, [file, *feed, at]).distinct().join(file_schemas(records, file, payload), file)
        chain = chained(known, feed, at, file, ["schema"])
        texts = settle(chain.select("*", shape_text(F.col("schema")).alias("text"), shape_text(F.col("previous_schema")).alias("previous_text")), "schemas")  # one row per file; all that follows reads it
        self.chain = texts.select(*chain.columns, F.md5("text").alias("shape"), F.md5("previous_text").alias("previous_shape"))
        self.scripts = settle(pair_scripts(texts.where("previous_file is not null")), "scripts")
        self.nodes = settle(shape_nodes(texts), "nodes")
        links = self.scripts.where("op in ('rename', 'move')").select("path", "to_path")
        self.fields = settle(field_classes(self.nodes.select("path", "shape"), links), "fields")


def changes(records: DataFrame, files: DataFrame, file: str, payload: str, feed: list[str], at: str) -> DataFrame:
    """(file, field_name, change_kind): added, removed, renamed and retyped fields of each file against the file before.

    Scripts decide what is added, removed and renamed. Kinds are compared over the whole chain, under any spelling, with
    the last earlier file that told one.
    """
    d = Drift(records, files, file, payload, feed, at)
    how = F.when(F.col("op").isin("rename", "move"), "renamed").when(F.col("op") == "add", "added").when(F.col("op") == "delete", "removed")
    side, _ = bounded(d.scripts.select("previous_shape", "shape", F.coalesce("to_path", "path").alias("p"), how.alias("change_kind")).where("change_kind is not null"))
    moved = d.chain.where("previous_file is not null").select(file, "previous_shape", "shape").join(side, ["previous_shape", "shape"]).select(file, _as_text("p").alias("field_name"), "change_kind")
    rank = F.coalesce(*[F.when(F.col("kind") == k, F.lit(r)) for k, r in RANK.items()], F.lit(RANK["text"] + 1))
    told, _ = bounded(d.nodes.where("kind <> 'null'").join(d.fields, "path").groupBy("shape", "field").agg(F.max(F.struct(rank.alias("r"), "kind")).alias("k"), F.max_by("path", rank).alias("path")))
    seen = d.chain.select(file, *feed, "position", "shape").join(told, "shape")
    w = Window.partitionBy(*feed, "field").orderBy("position")
    retyped = seen.withColumn("before", F.lag("k.kind").over(w)).where("before <> k.kind").select(file, _as_text("path").alias("field_name"), F.lit("retyped").alias("change_kind"))
    return moved.unionByName(retyped).distinct()


def _types(raw: DataFrame) -> DataFrame:
    """(path, kind, digits, scale, far): of each distinct leaf path the widest kind, and what its decimals need where long
    numbers occur; raw has (schema, long_numbers), distinct."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for schema, far in zip(b["schema"], b["long_numbers"], strict=True):
                for p, n in nodes(parse_schema(schema)).items():
                    if "[]" not in p and is_leaf(n):
                        m = re.fullmatch(r"DECIMAL\((\d+), ?(\d+)\)", n.note)
                        digits, scale = (int(m[1]), int(m[2])) if m else (0, 0)
                        rank = RANK["text"] if n.kind in (*NESTED, "boolean") else RANK[n.kind]
                        rows.append((list(p), rank, digits - scale, scale, bool(far and digits > SAFE_DIGITS), bool(far and n.note in ("DOUBLE", "FLOAT"))))
            yield pd.DataFrame(rows, columns=["path", "r", "whole", "scale", "wide", "lost"])

    got = raw.mapInPandas(run, "path array<string>, r int, whole int, scale int, wide boolean, lost boolean")
    return got.groupBy("path").agg(F.max("r").alias("r"), F.max("whole").alias("whole"), F.max("scale").alias("scale"), F.max("wide").alias("wide"), F.max("lost").alias("lost"))


def consistent_table(records: DataFrame, files: DataFrame, file: str, payload: str, keys: list[str], feed: list[str], at: str) -> DataFrame:
    """All payloads as one table: a column per field under its plainest spelling, in its widest type (the longest in
    words, then the one of most files), nested fields under the names of their path; `more_fields` maps the text paths of fields beyond MOST_COLUMNS to their values as JSON
    (of keys with both kinds of quotes, which no path can name, to the object that holds them).

    Decimals are doubles unless a file holds numbers longer than a double's digits, where they are exact decimals, or text
    beyond 38 digits. The columns are the plan of the result and come to the driver, at most MOST_COLUMNS; the projection
    of each distinct schema is put together by the executors and joined to the rows by file.
    """
    d = Drift(records, files, file, payload, feed, at)
    leaf = d.nodes.where("leaf").select("shape", "path").join(d.fields, "path")
    files_of = leaf.join(d.chain.groupBy("shape").agg(F.count("*").alias("n")), "shape").groupBy("path", "field").agg(F.sum("n").alias("n"))
    types = _types(d.chain.where("schema is not null").select("schema", "long_numbers").distinct())
    by_path = settle(files_of.join(types, "path"), "types")
    label = F.pandas_udf(lambda paths: paths.map(lambda p: "_".join("_".join(words(n)) for n in p)), "string")
    tops = by_path.withColumn("label", label("path")).groupBy("field").agg(
        F.max("r").alias("r"), F.max("whole").alias("whole"), F.max("scale").alias("scale"), F.max("wide").alias("wide"), F.max("lost").alias("lost"), F.sum("n").alias("n"),
        F.min(F.struct(-F.length("label"), -F.col("n"), "label")).alias("label"), F.min("path").alias("first"),
    ).orderBy(F.desc("n"), "first").limit(MOST_COLUMNS)
    fields, taken, columns = sorted(tops.collect(), key=lambda r: (r["label"]["label"], len(r["first"]), list(r["first"]))), {k.lower() for k in keys} | {"more_fields"}, []
    for r in fields:
        name = r["label"]["label"] or "field"
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        kind = {0: "string", 1: "bigint", 2: "double"}.get(r["r"], "string")
        if kind == "double" and (r["wide"] or r["lost"]):
            kind = f"decimal(38,{r['scale']})" if not r["lost"] and r["whole"] + r["scale"] <= 38 else "string"
        columns.append((name, kind, list(r["field"])))
    spark = records.sparkSession
    places = spark.createDataFrame([(f, i) for i, (_, _, f) in enumerate(columns)], "field array<string>, place int")
    inner = F.pandas_udf(lambda paths: paths.map(lambda p: variant_path(tuple(p))[0]), "string")
    whole = F.pandas_udf(lambda paths: paths.map(lambda p: variant_path(tuple(p))[1]), "boolean")
    at_place = leaf.join(F.broadcast(places), "field", "left").select("shape", F.when(whole("path"), F.col("place")).alias("place"), inner("path").alias("inner"), _as_text("path").alias("outer"))
    projection = at_place.groupBy("shape").agg(
        F.map_from_entries(F.collect_list(F.when(F.col("place").isNotNull(), F.struct("place", "inner")))).alias("m"), F.collect_list(F.when(F.col("place").isNull(), F.struct("outer", "inner"))).alias("others"),
    ).select("shape", F.transform(F.sequence(F.lit(0), F.lit(max(len(columns) - 1, 0))), lambda i: F.col("m")[i]).alias("_at"), "others")
    projection, _ = bounded(settle(projection, "projections"), 5_000)
    of_file, _ = bounded(d.chain.select(F.col(file).alias("_file"), "shape"))
    rows = _parsed(records, list(dict.fromkeys([*keys, file])), payload).where(F.expr(IS_OBJECT))
    rows = rows.join(of_file, F.col(file) == F.col("_file")).join(projection, "shape")
    out = []
    for i, (name, kind, _) in enumerate(columns):
        value = F.expr(f"try_variant_get(v, _at[{i}], '{kind}')")
        if kind == "string" and fields[i]["lost"]:  # the parsed number is rounded; the text is not
            value = F.coalesce(F.expr(f"""get_json_object(_payload, replace(replace(_at[{i}], '["', "['"), '"]', "']"))"""), value)
        out.append(value.alias(name))
    more = F.expr("map_filter(map_from_entries(transform(others, o -> struct(o.outer, cast(try_variant_get(v, o.inner, 'variant') as string)))), (k, x) -> x is not null)")
    got = rows.select(*keys, *out, more.alias("more_fields")).withColumn("_more", F.to_json("more_fields"))  # maps cannot be compared, their text can
    return got.dropDuplicates([*keys, *[n for n, _, _ in columns], "_more"]).drop("_more")


def cells(rows: DataFrame, keys: list[str]) -> DataFrame:
    """The consistent table as (keys..., field_name, value): one row for each value that is not null, as text."""
    fields = [c for c in rows.columns if c not in (*keys, "more_fields")]
    known = F.array(*[F.struct(F.lit(c).alias("field_name"), F.col("`" + c + "`").cast("string").alias("value")) for c in fields]).cast("array<struct<field_name:string,value:string>>")
    more = F.transform(F.map_entries("more_fields"), lambda e: F.struct(e["key"].alias("field_name"), e["value"].alias("value")))
    return rows.select(*keys, F.explode(F.concat(known, more)).alias("x")).select(*keys, "x.*").where("value is not null")
