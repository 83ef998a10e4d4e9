"""Text times of many forms and zones as unambiguous instants.

All forms are compiled into one regular expression, an alternation with named groups. One replacement takes every
component out of a value at once; ranges are checked against the calendar and the instant is put together by integer
arithmetic on days. Zones are resolved in the JVM; nothing leaves whole-stage code for Python.

Defined results: null, blank, unknown and out-of-calendar values have no instant; white space around a value is dropped;
digits beyond microseconds are cut off; a missing second is 0; an offset or zone in the value wins over the row's zone,
which wins over the default; an unknown zone name gives no instant; bare numbers of 9 to 11, 12 to 14, 15 to 16 and 17 to
19 digits count seconds, milli-, micro- and nanoseconds from 1970; a local time that a clock change skipped or repeated
has no instant unless the value states its offset.
"""

from __future__ import annotations

from zoneinfo import available_timezones

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quaystone.runtime import bounded, computed, pick, settle

# Month names and the offsets, in seconds, of zone abbreviations.
MONTHS = ("jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec")
ABBREVIATIONS = {"Z": 0, "UTC": 0, "GMT": 0, "EST": -18000, "EDT": -14400, "CST": -21600, "CDT": -18000, "MST": -25200, "MDT": -21600, "PST": -28800, "PDT": -25200}

DATES = (
    r"(?<y1>\d{4})-(?<m1>\d{1,2})-(?<d1>\d{1,2})",
    r"(?<y2>\d{4})/(?<m2>\d{1,2})/(?<d2>\d{1,2})",
    r"(?<p3>\d{1,2})/(?<q3>\d{1,2})/(?<y3>\d{4})",
    r"(?<d4>\d{1,2})\.(?<m4>\d{1,2})\.(?<y4>\d{4})",
    r"(?<d5>\d{1,2})[ -](?<n5>[A-Za-z]{3,9})\.?,?[ -](?<y5>\d{4})",
    r"(?<n6>[A-Za-z]{3,9})\.? (?<d6>\d{1,2}),? (?<y6>\d{4})",
)
CLOCK = r"(?<h1>\d{1,2}):(?<i1>\d{2})(?::(?<s1>\d{2})(?:[.,](?<f1>\d+))?)?"
COMPACT = r"(?<y7>\d{4})(?<m7>\d{2})(?<d7>\d{2})[T ](?<h7>\d{2})(?<i7>\d{2})(?:(?<s7>\d{2})(?:[.,](?<f7>\d+))?)?"
WEEKDAY = r"(?:[A-Za-z]{3,9},? )?"
ZONE = (
    r"(?:\s*(?<ap>[AaPp])\.?[Mm]\.?)?(?:\s*(?:(?<zn>[A-Za-z]{1,5})|(?<zs>[+-])(?<zh>\d{2}):?(?<zm>\d{2})?|\[?(?<zi>[A-Za-z]+/[A-Za-z_/+\-0-9]+)\]?))?"
)
PATTERN = r"^\s*(?:(?<e>\d{9,19})|(?:" + WEEKDAY + "(?:" + "|".join(DATES) + r")(?:[Tt]|,?\s+)" + CLOCK + "|" + COMPACT + ")" + ZONE + r")\s*$"
#: The part of the alternation whose order of day and month is open.
SLASHED = r"^\s*" + WEEKDAY + DATES[2] + r"(?:[Tt]|,?\s+)" + CLOCK + ZONE + r"\s*$"
#: The components in the order in which the replacement lists them.
PARTS = {
    "epoch": ("e",), "year": ("y1", "y2", "y3", "y4", "y5", "y6", "y7"), "month": ("m1", "m2", "m4", "m7"), "day": ("d1", "d2", "d4", "d5", "d6", "d7"), "first": ("p3",), "second": ("q3",), "name": ("n5", "n6"),
    "h": ("h1", "h7"), "mi": ("i1", "i7"), "s": ("s1", "s7"), "frac": ("f1", "f7"), "half": ("ap",), "zname": ("zn",), "sign": ("zs",), "zhour": ("zh",), "zmin": ("zm",), "zone": ("zi",),
}
DAY_US = 86_400_000_000


def known_zones(spark: SparkSession) -> list[str]:
    try:
        return sorted(spark._jvm.java.time.ZoneId.getAvailableZoneIds())
    except Exception:  # noqa: BLE001  (a remote session has no JVM gateway)
        return sorted(available_timezones())


def components(df: DataFrame, text: str) -> DataFrame:
    """df with a struct `at` of the value's components as text, null where the value has no known form."""
    listed = "|".join("".join(f"${{{g}}}" for g in groups) for groups in PARTS.values())
    df = computed(df, _all=F.regexp_replace(F.col(text), PATTERN, "\u0001" + listed))  # one match; the mark tells a hit from a text left as it is
    df = computed(df, _hit=F.when(F.col("_all").startswith("\u0001") & ~F.col(text).startswith("\u0001"), F.split(F.substr("_all", F.lit(2)), r"\|"))).drop("_all")
    parts = [F.nullif(F.col("_hit")[i], F.lit("")).alias(name) for i, name in enumerate(PARTS)]
    return computed(df, at=F.when(F.col("_hit").isNotNull(), F.struct(*parts))).drop("_hit")


def day_first(df: DataFrame, groups: list[str], text: str) -> DataFrame:
    """(groups..., day_first) of the groups whose dates with slashes show their order; only such dates are matched here."""
    hit = F.when(F.col(text).contains("/"), F.regexp_replace(F.col(text), SLASHED, "\u0001${p3}|${q3}"))
    df = computed(df.select(*groups, hit.alias("_h")).where("_h like '\u0001%'"), _p=F.substring_index(F.substr("_h", F.lit(2)), "|", 1), _q=F.substring_index("_h", "|", -1))
    p, q = F.expr("try_cast(_p as int)"), F.expr("try_cast(_q as int)")
    shown = F.when(p.between(13, 31) & q.between(1, 12), 1).when(q.between(13, 31) & p.between(1, 12), 0)
    votes = df.select(*groups, shown.alias("v")).where("v is not null").groupBy(*groups).agg(F.sum("v").alias("yes"), F.count("v").alias("n"))
    return votes.select(*groups, (F.col("yes") * 2 > F.col("n")).alias("day_first"))


def _days(y: Column, m: Column, d: Column) -> Column:
    """Days from 1970-01-01 to a date of the Gregorian calendar, by integers alone (years from March)."""
    yy = F.when(m <= 2, y - 1).otherwise(y)
    div = lambda a, b: F.call_function("floor", a / b).cast("long")
    doy = div((F.when(m > 2, m - 3).otherwise(m + 9)) * 153 + 2, F.lit(5)) + d - 1
    return yy * 365 + div(yy, F.lit(4)) - div(yy, F.lit(100)) + div(yy, F.lit(400)) + doy - 719468


def _offset_us(instant: Column, zone: Column) -> Column:
    return F.unix_micros(F.from_utc_timestamp(F.timestamp_micros(instant), zone)) - instant


def instants(df: DataFrame, zone: str, default_zone: str, out: str = "utc_micros") -> DataFrame:
    """df, which has `at` and `day_first`, with the instant as microseconds since 1970 in `out`, or null."""
    num = lambda n: F.col(f"at.{n}").cast("long")
    dmy = F.col("day_first")
    named = F.array_position(F.array(*[F.lit(x) for x in MONTHS]), F.lower(F.substring("at.name", 1, 3)))
    month = F.when(F.col("at.name").isNotNull(), named).when(F.col("at.first").isNotNull(), F.when(dmy, num("second")).when(~dmy, num("first")).when(num("first") == num("second"), num("first"))).otherwise(num("month"))
    day = F.when(F.col("at.first").isNotNull(), F.when(dmy, num("first")).when(~dmy, num("second")).when(num("first") == num("second"), num("first"))).otherwise(num("day"))
    half = F.lower("at.half")
    hour = F.when(half.isNull(), num("h")).when(num("h").between(1, 12), num("h") % 12 + F.when(half == "p", 12).otherwise(0))
    frac = F.rpad(F.substring(F.coalesce(F.col("at.frac"), F.lit("0")), 1, 6), 6, "0").cast("long")
    digits = F.length("at.epoch")
    e = F.expr("try_cast(at.epoch as long)")
    epoch = F.when(digits <= 11, e * 1_000_000).when(digits <= 14, e * 1000).when(digits <= 16, e).otherwise(F.expr("try_cast(at.epoch as long) div 1000"))
    fixed = F.coalesce(*[F.when(F.upper("at.zname") == k, v) for k, v in ABBREVIATIONS.items()])
    stated = F.when(num("zhour").between(0, 18) & F.coalesce(num("zmin"), F.lit(0)).between(0, 59), (num("zhour") * 3600 + F.coalesce(num("zmin"), F.lit(0)) * 60) * F.when(F.col("at.sign") == "-", -1).otherwise(1))
    df = computed(df, _y=num("year"), _m=month, _d=day, _h=hour, _i=num("mi"), _s=F.coalesce(num("s"), F.lit(0)), _f=frac, _e=epoch)
    leap = ((F.col("_y") % 4 == 0) & (F.col("_y") % 100 != 0)) | (F.col("_y") % 400 == 0)
    last = F.when(F.col("_m") == 2, F.when(leap, 29).otherwise(28)).when(F.col("_m").isin(4, 6, 9, 11), 30).otherwise(31)
    valid = F.col("_y").between(1, 9998) & F.col("_m").between(1, 12) & F.col("_d").between(1, last) & F.col("_h").between(0, 23) & F.col("_i").between(0, 59) & F.col("_s").between(0, 59)
    local = _days(F.col("_y"), F.col("_m"), F.col("_d")) * DAY_US + ((F.col("_h") * 60 + F.col("_i")) * 60 + F.col("_s")) * 1_000_000 + F.col("_f")
    own = F.coalesce(F.col("at.zone"), F.nullif(F.trim(F.col(zone)), F.lit("")), F.lit(default_zone))
    bare = F.col("at.zname").isNull() & F.col("at.sign").isNull()
    df = computed(df, _l=F.when(valid, local), _o=F.coalesce(fixed, stated).cast("long"), _z=F.when(bare & own.isin(known_zones(df.sparkSession)), own))
    df = computed(df, _o1=_offset_us(F.col("_l") - DAY_US, F.col("_z")), _o2=_offset_us(F.col("_l") + DAY_US, F.col("_z")))
    df = computed(df, **{f"_u{i}": F.when(_offset_us(F.col("_l") - F.col(f"_o{i}"), F.col("_z")) == F.col(f"_o{i}"), F.col("_l") - F.col(f"_o{i}")) for i in (1, 2)})
    civil = F.when(F.col("_u1").isNull(), F.col("_u2")).when(F.col("_u2").isNull() | (F.col("_u1") == F.col("_u2")), F.col("_u1"))
    result = F.when(F.col("at.epoch").isNotNull(), F.col("_e")).when(~bare, F.col("_l") - F.col("_o") * 1_000_000).otherwise(civil)
    return df.withColumn(out, result).drop(*[c for c in df.columns if c.startswith("_")])


def stamp_instants(stamps: DataFrame, key: str, groups: list[str], fields: list[str], zone: str, default_zone: str = "America/New_York") -> DataFrame:
    """(key, field_name, utc_micros) of each text field that names exactly one instant.

    The order of day and month is voted on per group from partial counts; the few result rows are broadcast within the
    bound, beyond it they shuffle and adaptive execution splits hot groups. Every value is taken apart once; the votes read
    dates with slashes alone.
    """
    each = F.explode(F.array(*[F.struct(F.lit(f).alias("field_name"), F.col(f).alias("value")) for f in fields]))
    long = pick(stamps, list(dict.fromkeys([key, *groups, zone, *fields]))).select(key, *groups, zone, each.alias("x")).select(key, *groups, zone, "x.field_name", "x.value")
    order, _ = bounded(settle(day_first(long, groups, "value"), "orders"))
    got = instants(components(long, "value").where("at is not null").join(order, groups, "left"), zone, default_zone)
    return got.where("utc_micros is not null").select(key, "field_name", "utc_micros").distinct()
