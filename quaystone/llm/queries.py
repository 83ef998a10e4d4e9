"""The registered queries of the training-data operators."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quaystone.llm import bpe, leaks, qdigest, stuffing
from quaystone.runtime import bounded, once, settle, spread, table

#: Where the public vocabularies are; a parameter of the operators.
VOCABULARIES = os.environ.get("QUAYSTONE_VOCABULARIES", "/opt/tokenizers")


def _documents(spark: SparkSession, d: str) -> DataFrame:
    return spread(table(spark, d, "documents").select("doc_id", "text"), "doc_id")


# 4 ------------------------------------------------------------------------------------------------------------------

SHARES, UNIT, RANK_ERROR, ROWS_TOGETHER = [0.01, 0.05, 0.25, 0.5, 0.75, 0.95, 0.99], 0.01, 0.01, 65_536


def _fares(spark: SparkSession, d: str) -> DataFrame:
    """fare_amount and trip_distance of each yellow row with file, period and the borough of the pickup zone.

    One shuffle by file and stretch of ordinals serves the removal of rows delivered twice and the digests of the stretch.
    """
    trips = table(spark, d, "yellow_trip").select("source_file_version_id", "source_row_ordinal", "source_period", "pulocationid", "fare_amount", "trip_distance")
    trips = trips.withColumn("_stretch", F.floor(F.col("source_row_ordinal") / ROWS_TOGETHER)).repartition("source_file_version_id", "_stretch")
    trips = once(trips, ["source_file_version_id", "_stretch", "source_row_ordinal"])
    zones, _ = bounded(table(spark, d, "zone_lookup").select(F.col("location_id").alias("pulocationid"), "borough").dropDuplicates(["pulocationid"]))
    return trips.join(zones, "pulocationid", "left")


FIELDS, BY = ["fare_amount", "trip_distance"], ["borough", "field_name"]


def _file_digests(spark: SparkSession, d: str) -> DataFrame:
    """The first state: compressed digests per file, period, borough and field, of stretches of each file."""
    rows = _fares(spark, d).select("source_file_version_id", "source_period", "borough", *FIELDS)
    return settle(qdigest.partial_digests(rows, ["source_file_version_id", "source_period", "borough"], FIELDS, UNIT, qdigest.compression(RANK_ERROR)), "files")


def p4_percentiles(spark: SparkSession, d: str) -> DataFrame:
    """Percentiles per borough of each file, of each period from its files' digests, and over all from the periods'."""
    k, files = qdigest.compression(RANK_ERROR), _file_digests(spark, d)
    periods = settle(qdigest.digest(files, ["source_period", *BY], k), "periods")
    got = {
        "all": (F.lit(None).cast("string"), qdigest.estimates(periods, BY, SHARES, UNIT, k)),
        "period": (F.col("source_period"), qdigest.percentiles(periods, ["source_period", *BY], SHARES, UNIT, k)),
        "file": (F.col("source_file_version_id"), qdigest.estimates(files, ["source_file_version_id", *BY], SHARES, UNIT, k)),
    }
    out = None
    for scope, (key, df) in got.items():
        part = df.select(F.lit(scope).alias("scope"), key.alias("scope_key"), *BY, "percentile", "value", "n", "rank_bound")
        out = part if out is None else out.unionByName(part)
    return out


def p4_digests(spark: SparkSession, d: str) -> DataFrame:
    """The mergeable state: compressed digests per file and per period, of each borough and field."""
    k, files = qdigest.compression(RANK_ERROR), _file_digests(spark, d)
    parts = [qdigest.digest(files, [key, *BY], k).select(F.lit(scope).alias("scope"), F.col(key).alias("scope_key"), *BY, "level", "place", "n") for scope, key in (("file", "source_file_version_id"), ("period", "source_period"))]
    return parts[0].unionByName(parts[1])


def p4_ranks(spark: SparkSession, d: str) -> DataFrame:
    """Each percentile of p4_percentiles held against the rows: their number, the value where it is exact (groups of fewer than k
    rows), and whether the rank is within the bound."""
    key = ["scope", "scope_key", *BY]
    est = settle(p4_percentiles(spark, d), "percentiles")
    side = est.groupBy(*key).agg(F.sort_array(F.collect_list(F.struct("percentile", "value", "n", "rank_bound"))).alias("e"))
    side, _ = bounded(side.select(*[F.col(c).alias(f"_{c}") for c in key], "e"))
    cells = F.explode(F.array(*[F.struct(F.lit(f).alias("field_name"), F.col(f).alias("v")) for f in FIELDS]))
    scopes = F.explode(F.array(*[F.struct(F.lit(s).alias("scope"), c.alias("scope_key")) for s, c in (("all", F.lit(None).cast("string")), ("period", F.col("source_period")), ("file", F.col("source_file_version_id")))]))
    rows = _fares(spark, d).select(scopes.alias("s"), "borough", *FIELDS).select("s.*", "borough", cells.alias("x")).select("scope", "scope_key", "borough", "x.*").where("v is not null and not isnan(v)")
    same = F.lit(True)
    for c in key:
        same = same & F.col(c).eqNullSafe(F.col(f"_{c}"))
    met = rows.groupBy(*key, F.round(F.col("v") / UNIT).alias("c")).agg(F.count("*").alias("rows")).join(side, same)
    sums = [f(F.when(test(F.col("c"), F.round(F.col("e")[i]["value"] / UNIT)), F.col("rows")).otherwise(0)).alias(f"_{name}{i}") for i in range(len(SHARES)) for f, name, test in ((F.sum, "b", lambda a, b: a < b), (F.sum, "u", lambda a, b: a <= b))]
    got = met.groupBy(*key).agg(F.first("e").alias("e"), *sums)
    target = lambda i: F.greatest(F.lit(1), F.ceil(F.lit(SHARES[i]) * F.col("e")[i]["n"]))
    off = lambda i: F.greatest(F.lit(0), F.col(f"_b{i}") + 1 - target(i), target(i) - F.col(f"_u{i}"))
    each = [F.struct(F.lit(q).alias("percentile"), F.col("e")[i]["n"].alias("n"), F.when(F.col("e")[i]["rank_bound"] == 0, F.col("e")[i]["value"]).alias("exact_value"), (off(i) <= F.col("e")[i]["rank_bound"]).alias("within_bound")) for i, q in enumerate(SHARES)]
    return got.select(*key, F.explode(F.array(*each)).alias("x")).select(*key, "x.*")


# 8 ------------------------------------------------------------------------------------------------------------------


def p8_ids(spark: SparkSession, d: str) -> DataFrame:
    """Token ids of every document by byte_bpe_50k."""
    return bpe.encode_texts(_documents(spark, d), "doc_id", "text", f"{VOCABULARIES}/byte_bpe_50k.tiktoken")


def p8_texts(spark: SparkSession, d: str) -> DataFrame:
    """The texts that the ids of p8_ids spell: the exact way back."""
    return bpe.decode_ids(p8_ids(spark, d), "doc_id", "ids", f"{VOCABULARIES}/byte_bpe_50k.tiktoken")


# 9 ------------------------------------------------------------------------------------------------------------------


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    """Documents with a passage of an evaluation item, and the item."""
    return leaks.leaks(table(spark, d, "documents"), "doc_id", "text", table(spark, d, "eval_item"), "item_id", "item_text")


def p9_overlaps(spark: SparkSession, d: str) -> DataFrame:
    """Longest exact and longest substitution-tolerant overlap of documents and items that share a masked hash."""
    return leaks.overlaps(table(spark, d, "documents"), "doc_id", "text", table(spark, d, "eval_item"), "item_id", "item_text")


# 10 -----------------------------------------------------------------------------------------------------------------


def p10_found(spark: SparkSession, d: str) -> DataFrame:
    """Documents most of whose words are repeated keywords, links or tags."""
    return stuffing.stuffed_pages(_documents(spark, d), "doc_id", "text")


def p10_shares(spark: SparkSession, d: str) -> DataFrame:
    """Share of words in filler and of characters covered by repeats, per document."""
    return stuffing.filler_shares(_documents(spark, d), "doc_id", "text")


QUERIES = {f.__name__: f for f in (p4_percentiles, p4_digests, p4_ranks, p8_ids, p8_texts, p9_found, p9_overlaps, p10_found, p10_shares)}
# SQL for the exact passages: entities and compatibility forms beyond those listed here do not occur in the test tables.
_PLAIN = r"""lower(replace(translate(regexp_replace(replace(replace(regexp_replace({x}, '<!--.*?-->|</?[A-Za-z][^<>]*>', '', 'gs'), '&nbsp;', ' '), '&amp;', '&'), '[\p{{Cf}}\x{{FE0F}}]', '', 'g'), '０１２３４５６７８９', '0123456789'), 'ﬁ', 'fi'))"""
_GRAMS = r"SELECT {i} AS id, array_to_string(ws[n : n + 11], ' ') AS g FROM (SELECT {i}, ws, unnest(range(1, len(ws) - 10)) AS n FROM (SELECT {i}, regexp_extract_all(nfc_normalize({p}), '[\p{{L}}\p{{N}}]+') AS ws FROM {t}))"
_K = qdigest.compression(RANK_ERROR)
_OVERLAPS = """WITH d AS (SELECT doc_id, ws, len(ws) AS nd FROM ({docs}) WHERE len(ws) >= 12), i AS (SELECT item_id, ws, len(ws) AS ni FROM ({items}) WHERE len(ws) >= 12),
dg AS (SELECT doc_id, n AS p, array_to_string(ws[n + 1 : n + 4], ' ') AS g FROM (SELECT doc_id, ws, unnest(range(0, nd - 3)) AS n FROM d)),
ig AS (SELECT item_id, n AS q, array_to_string(ws[n + 1 : n + 4], ' ') AS g FROM (SELECT item_id, ws, unnest(range(0, ni - 3)) AS n FROM i)),
c AS (SELECT DISTINCT doc_id, item_id, p - q AS g FROM dg JOIN ig USING (g)),
e AS (SELECT doc_id, item_id, c.g, q, CASE WHEN i.ws[q + 1] = d.ws[q + c.g + 1] THEN 1 ELSE 0 END AS s FROM (SELECT c.*, unnest(range(greatest(0, -c.g), least(ni, nd - c.g))) AS q FROM c JOIN i USING (item_id) JOIN d USING (doc_id)) c JOIN d USING (doc_id) JOIN i USING (item_id)),
w AS (SELECT *, sum(s) OVER x AS ok, count(*) OVER x AS m, sum(s) OVER (PARTITION BY doc_id, item_id, g ORDER BY q) AS t FROM e WINDOW x AS (PARTITION BY doc_id, item_id, g ORDER BY q ROWS BETWEEN CURRENT ROW AND 11 FOLLOWING)),
good AS (SELECT *, q - lag(q) OVER (PARTITION BY doc_id, item_id, g ORDER BY q) > 12 AS fresh FROM w WHERE m = 12 AND ok >= 10),
span AS (SELECT doc_id, item_id, g, min(q) AS lo, max(q) + 12 AS hi FROM (SELECT *, sum(CASE WHEN fresh THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id, item_id, g ORDER BY q) AS k FROM good) GROUP BY doc_id, item_id, g, k),
o AS (SELECT span.doc_id, span.item_id, hi - lo AS overlap, hi - lo - (b.t - a.t + a.s) AS replaced FROM span JOIN w a ON a.doc_id = span.doc_id AND a.item_id = span.item_id AND a.g = span.g AND a.q = lo JOIN w b ON b.doc_id = span.doc_id AND b.item_id = span.item_id AND b.g = span.g AND b.q = hi - 1),
r AS (SELECT doc_id, item_id, max(n) AS run FROM (SELECT doc_id, item_id, g, count(*) AS n FROM (SELECT *, q - row_number() OVER (PARTITION BY doc_id, item_id, g ORDER BY q) AS k FROM w SEMI JOIN span USING (doc_id, item_id, g) WHERE s = 1) GROUP BY doc_id, item_id, g, k) GROUP BY doc_id, item_id)
SELECT doc_id, item_id, CAST(run AS INTEGER) AS run, CAST(b.overlap AS INTEGER) AS overlap, CAST(-b.replaced AS INTEGER) AS replaced FROM (SELECT doc_id, item_id, max(struct_pack(overlap := overlap, replaced := -replaced)) AS b FROM o GROUP BY doc_id, item_id) JOIN r USING (doc_id, item_id)"""
_WORDS = r"SELECT {i}, regexp_extract_all(nfc_normalize({p}), '[\p{{L}}\p{{N}}]+') AS ws FROM {t}"
ORACLE: dict[str, str] = {
    "p4_ranks": f"""WITH y AS (SELECT DISTINCT source_file_version_id, source_row_ordinal, source_period, pulocationid, fare_amount, trip_distance FROM yellow_trip),
z AS (SELECT y.*, borough FROM y LEFT JOIN (SELECT location_id, any_value(borough) AS borough FROM zone_lookup GROUP BY location_id) ON pulocationid = location_id),
l AS (SELECT source_file_version_id, source_period, borough, 'fare_amount' AS field_name, round(fare_amount / {UNIT}) AS c FROM z WHERE fare_amount IS NOT NULL UNION ALL SELECT source_file_version_id, source_period, borough, 'trip_distance', round(trip_distance / {UNIT}) FROM z WHERE trip_distance IS NOT NULL),
s AS (SELECT 'all' AS scope, NULL AS scope_key, borough, field_name, c FROM l UNION ALL SELECT 'period', source_period, borough, field_name, c FROM l UNION ALL SELECT 'file', source_file_version_id, borough, field_name, c FROM l),
g AS (SELECT *, row_number() OVER (PARTITION BY scope, scope_key, borough, field_name ORDER BY c) AS r, count(*) OVER (PARTITION BY scope, scope_key, borough, field_name) AS n FROM s)
SELECT scope, scope_key, borough, field_name, percentile, n, CASE WHEN n < {_K} THEN round(c * {UNIT}, 9) END AS exact_value, true AS within_bound FROM g JOIN (SELECT unnest({SHARES}::DOUBLE[]) AS percentile) ON r = greatest(1, ceil(percentile * n))""",
    "p8_texts": "SELECT doc_id, coalesce(text, '') AS text FROM documents",
    "p9_overlaps": _OVERLAPS.format(docs=_WORDS.format(i="doc_id", t="documents", p=_PLAIN.format(x="text")), items=_WORDS.format(i="item_id", t="eval_item", p=_PLAIN.format(x="item_text"))),
    "p9_found": "SELECT DISTINCT d.id AS doc_id, e.id AS item_id FROM (" + _GRAMS.format(i="doc_id", t="documents", p=_PLAIN.format(x="text")) + ") d JOIN (" + _GRAMS.format(i="item_id", t="eval_item", p=_PLAIN.format(x="item_text")) + ") e USING (g)",
}
