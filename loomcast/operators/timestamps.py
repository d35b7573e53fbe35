"""Mixed timestamp texts to one UTC instant.

Everything runs in the JVM: each text is rewritten once by the first matching layout into `y|m|d|H|M|S|frac|half|zone|iana`,
the fields are checked by arithmetic, and the zone rules come from the JVM's tz database through `from_utc_timestamp`.

Results per value (`normalize`):
    instant       microseconds since 1970 and its text `YYYY-MM-DDThh:mm:ss.ffffffZ`; digits beyond the sixth are cut off
    ambiguous     the local time occurs twice on its clock
    nonexistent   the local time is skipped on its clock
    unreadable    no valid date and time, a relative phrase, or a zone that is unknown or can't be found
NULL, empty and blank texts give NULL. Rows are never dropped; repeated rows give repeated results.
"""

from __future__ import annotations

import re
from functools import reduce
from itertools import chain

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Zone abbreviations and their offsets from UTC in minutes.
ABBREVIATIONS = {
    "Z": 0, "UT": 0, "UTC": 0, "GMT": 0, "WET": 0, "WEST": 60, "BST": 60, "CET": 60, "CEST": 120, "EET": 120, "EEST": 180, "MSK": 180,
    "IST": 330, "SGT": 480, "HKT": 480, "AWST": 480, "JST": 540, "KST": 540, "ACST": 570, "ACDT": 630, "AEST": 600, "AEDT": 660, "NZST": 720, "NZDT": 780,
    "AST": -240, "ADT": -180, "NST": -210, "NDT": -150, "EST": -300, "EDT": -240, "CST": -360, "CDT": -300, "MST": -420, "MDT": -360, "PST": -480, "PDT": -420, "AKST": -540, "AKDT": -480, "HST": -600,
}

# The first letters that tell a month's name in the languages of the feeds.
MONTHS = {
    "jan": 1, "ene": 1, "feb": 2, "fév": 2, "fev": 2, "mar": 3, "mär": 3, "mae": 3, "apr": 4, "abr": 4, "avr": 4, "may": 5, "mai": 5, "mayo": 5, "jun": 6, "juin": 6,
    "jul": 7, "juil": 7, "aug": 8, "ago": 8, "aoû": 8, "sep": 9, "set": 9, "oct": 10, "okt": 10, "out": 10, "nov": 11, "dec": 12, "dez": 12, "dic": 12, "déc": 12,
}

#: By how much a row's lag may differ from the usual: less than the step between neighbouring zones.
TOLERANCE_S = 900

#: Common zones: of histories that fit as well, one of these is preferred.
COMMON_ZONES = (
    "UTC", "America/New_York", "America/Chicago", "America/Denver", "America/Los_Angeles", "America/Sao_Paulo", "America/Mexico_City", "Europe/London", "Europe/Berlin",
    "Europe/Moscow", "Asia/Kolkata", "Asia/Shanghai", "Asia/Tokyo", "Australia/Sydney", "Pacific/Auckland",
)

_ZONE = r"(?:\s*(Z|z|[+-]\d{2}:?\d{2}|[A-Z]{2,5}))?(?:\s*\[?([A-Za-z]+(?:/[A-Za-z0-9_+-]+)+)\]?)?$"
_TIME = r"(\d{1,2}):(\d{2})(?::(\d{2})(?:[.,](\d+))?)?"
_NAME = r"(\p{L}{3,9})\.?"

#: (layout, rewriting); the date's parts come as y|m|d, or as `?|a|b|y` where the source's day order decides.
_LAYOUTS = [
    (r"^(\d{4})-(\d{1,2})-(\d{1,2})(?:[Tt\s]\s*" + _TIME + ")?" + _ZONE, "$1|$2|$3|$4|$5|$6|$7||$8|$9"),
    (r"^(\d{4})(\d{2})(\d{2})[Tt](\d{2})(\d{2})(?:(\d{2})(?:[.,](\d+))?)?" + _ZONE, "$1|$2|$3|$4|$5|$6|$7||$8|$9"),
    (r"^(?:\p{L}{2,9}\.?,?\s+)?(\d{1,2})\.?[\s-]+" + _NAME + r"[\s-]+(\d{4})(?:,?\s+" + _TIME + r"(?:\s*Uhr)?)?" + _ZONE, "$3|$2|$1|$4|$5|$6|$7||$8|$9"),
    (r"^(?:\p{L}{2,9}\.?,\s+)?" + _NAME + r"\s+(\d{1,2}),?\s+(\d{4})(?:,?\s+" + _TIME + r"\s*([AaPp][Mm])?)?" + _ZONE, "$3|$1|$2|$4|$5|$6|$7|$8|$9|$10"),
    (r"^(\d{1,2})([./-])(\d{1,2})\2(\d{4})(?:,?\s+(\d{1,2})[:.](\d{2})(?:[:.](\d{2})(?:,(\d+))?)?\s*([AaPp][Mm])?(?:\s*Uhr)?)?" + _ZONE, "?$4|$1|$3|$5|$6|$7|$8|$9|$10|$11"),
    (r"^(\d{4})([/.])(\d{1,2})\2(\d{1,2})(?:[Tt\s]\s*" + _TIME + r"\s*([AaPp][Mm])?)?" + _ZONE, "$1|$3|$4|$5|$6|$7|$8|$9|$10|$11"),
    (r"^(\d{4})\s*年\s*(\d{1,2})\s*月\s*(\d{1,2})\s*日\s*(上午|下午|午前|午後|凌晨|早上|晚上)?\s*(?:(\d{1,2})[:：时時点](\d{1,2})(?:[:：分](\d{1,2}))?[分秒]?)?" + _ZONE, "$1|$2|$3|$5|$6|$7||$4|$8|$9"),
]


def known_zones(spark: SparkSession) -> list[str]:
    """The zone ids of the JVM that will resolve them (some 600: a fixed set)."""
    return sorted(str(z) for z in spark._jvm.java.time.ZoneId.getAvailableZoneIds() if "/" in str(z) or str(z) == "UTC")


def distinct_histories(spark: SparkSession, since_micros: int) -> list[str]:
    """One zone of each offset history from then on (a fixed set): a common one if there is any, else the first by name."""
    since = spark._jvm.java.time.Instant.ofEpochSecond(since_micros // 1_000_000)
    year = str(1970 + since_micros // 31_556_952_000_000 - 1)
    found: dict[tuple, str] = {}
    for zone in sorted(known_zones(spark), key=lambda z: (z not in COMMON_ZONES, z.startswith(("Etc/", "SystemV/")), z)):
        rules = spark._jvm.java.time.ZoneId.of(zone).getRules()
        later = tuple(x for x in re.findall(r"Transition\[[^\[\]]*\]", str(rules.getTransitions().toString())) if re.search(r" at (\d{4})", x)[1] >= year)
        found.setdefault((str(rules.getOffset(since).toString()), later, str(rules.getTransitionRules().toString())), zone)
    return list(found.values())


def _bind(df: DataFrame, **columns: Column) -> DataFrame:
    """Adds columns that are worked out once: the generator keeps Catalyst from copying their expressions into each use."""
    return df.select("*", F.inline(F.array(F.struct(*[c.alias(n) for n, c in columns.items()]))))


def _local(micros: Column, zone: Column) -> Column:
    return F.unix_micros(F.from_utc_timestamp(F.timestamp_micros(micros), zone))


def utc_text(micros: Column) -> Column:
    """`YYYY-MM-DDThh:mm:ss.ffffffZ` of microseconds since 1970, whatever the session's time zone is."""
    day = F.floor(micros / F.lit(86_400_000_000)).cast("int")
    rest = F.pmod(micros, F.lit(86_400_000_000))
    two = lambda c: F.lpad(c.cast("int").cast("string"), 2, "0")
    return F.concat(
        F.date_from_unix_date(day).cast("string"), F.lit("T"), two(F.floor(rest / 3_600_000_000)), F.lit(":"), two(F.floor(rest / 60_000_000) % 60),
        F.lit(":"), two(F.floor(rest / 1_000_000) % 60), F.lit("."), F.lpad((rest % 1_000_000).cast("string"), 6, "0"), F.lit("Z"),
    )


def _fields(text: Column) -> Column:
    out = F.lit(None).cast("string")
    for layout, rewriting in reversed(_LAYOUTS):
        out = F.when(text.rlike(layout), F.regexp_replace(text, layout, rewriting)).otherwise(out)
    return F.split(out, r"\|")


def with_parts(df: DataFrame, text: str, day_order: str, zones: list[str]) -> DataFrame:
    """Adds `_local` (local microseconds), `_epoch`, `_offset` (minutes) and `_named` (zone id) of the text, NULL where unknown, and `_bad`.

    Exactly one of three holds for a readable value: `_epoch` is the instant itself, or `_local` has an `_offset`, or `_local` is read on a clock.
    """
    clean = F.regexp_replace(F.col(text), r"^[\s 　﻿]+|[\s 　﻿]+$", "")
    months = F.create_map(*chain.from_iterable((F.lit(k), F.lit(v)) for k, v in MONTHS.items()))
    part = lambda i: F.try_element_at("_f", F.lit(i))
    num = lambda i: part(i).try_cast("int")
    df = _bind(_bind(df, _t=clean), _f=_fields(F.col("_t")))
    by_order = part(1).startswith("?")
    order = F.coalesce(F.col(day_order), F.lit("ymd"))
    first, second = num(2), num(3)
    # A year-last date on a ymd clock: the day first if dots or hyphens part it.
    day_first = (order == "dmy") | ((order == "ymd") & F.col("_t").rlike(r"^\d+[.-]"))
    name = F.lower(part(2))
    df = _bind(
        df,
        _y=F.regexp_replace(part(1), r"^\?", "").try_cast("int"),
        _mo=F.when(by_order, F.when(day_first, second).otherwise(first)).otherwise(
            F.coalesce(first, F.try_element_at(months, F.substring(name, 1, 4)), F.try_element_at(months, F.substring(name, 1, 3)))
        ),
        _d=F.when(by_order, F.when(day_first, first).otherwise(second)).otherwise(second),
        _half=F.lower(part(8)),
        _h0=F.coalesce(num(4), F.lit(0)),
        _mi=F.coalesce(num(5), F.lit(0)),
        _s=F.coalesce(num(6), F.lit(0)),
        _us=F.rpad(F.substring(F.coalesce(part(7), F.lit("")), 1, 6), 6, "0").cast("long"),
        _z=F.upper(part(9)),
        _iana=F.nullif(part(10), F.lit("")),
    )
    late, early = F.col("_half").isin("pm", "下午", "午後", "晚上"), F.col("_half").isin("am", "上午", "午前", "凌晨", "早上")
    df = _bind(df, _h=F.when(late & (F.col("_h0") < 12), F.col("_h0") + 12).when(early & (F.col("_h0") == 12), 0).otherwise(F.col("_h0")))
    leap = (F.col("_y") % 4 == 0) & ((F.col("_y") % 100 != 0) | (F.col("_y") % 400 == 0))
    length = F.when(F.col("_mo") == 2, F.when(leap, 29).otherwise(28)).when(F.col("_mo").isin(4, 6, 9, 11), 30).otherwise(31)
    valid = (
        F.col("_y").between(1, 9999) & F.col("_mo").between(1, 12) & (F.col("_d") >= 1) & (F.col("_d") <= length)
        & (F.col("_h") <= 23) & (F.col("_mi") <= 59) & (F.col("_s") <= 59) & ~((late | early) & (F.col("_h0") > 12))
    )
    offset = F.when(
        F.col("_z").rlike(r"^[+-]\d"),
        F.when(F.col("_z").startswith("-"), -1).otherwise(1) * (F.substring("_z", 2, 2).try_cast("int") * 60 + F.expr("right(_z, 2)").try_cast("int")),
    ).otherwise(F.try_element_at(F.create_map(*chain.from_iterable((F.lit(k), F.lit(v)) for k, v in ABBREVIATIONS.items())), F.col("_z")))
    stated = F.coalesce(F.length("_z"), F.lit(0)) > 0
    df = _bind(df, _valid=F.coalesce(valid, F.lit(False)), _minutes=offset, _named_zone=F.col("_iana").isin(zones))
    whole, fraction = F.regexp_extract("_t", r"^(-?\d+)(?:\.(\d+))?$", 1), F.regexp_extract("_t", r"^(-?\d+)(?:\.(\d+))?$", 2)
    n = whole.try_cast("long")
    sub = lambda places: F.rpad(F.substring(F.concat(fraction, F.lit("000000")), 1, places), places, "0").cast("long")
    epoch = F.when(
        F.col("_t").rlike(r"^\d+(\.\d+)?$") & n.isNotNull(),
        F.when(n < 100_000_000_000, n * 1_000_000 + sub(6)).when(n < 100_000_000_000_000, n * 1000 + sub(3)).when(n < 100_000_000_000_000_000, n).otherwise(F.floor(n / F.lit(1000)).cast("long")),
    )
    # Division of longs goes through doubles, too coarse for nanoseconds: cut the digits off instead.
    epoch = F.when(F.length(whole).between(18, 19), F.expr("substring(_t, 1, length(regexp_extract(_t, '^(\\\\d+)', 1)) - 3)").try_cast("long")).otherwise(epoch)
    local = F.when(
        F.col("_valid"),
        F.unix_date(F.make_date("_y", "_mo", "_d")).cast("long") * 86_400_000_000 + (F.col("_h") * 3600 + F.col("_mi") * 60 + F.col("_s")).cast("long") * 1_000_000 + F.col("_us"),
    )
    bad_zone = (stated & (F.col("_minutes").isNull() | (F.abs("_minutes") > 18 * 60))) | (~stated & F.col("_iana").isNotNull() & ~F.col("_named_zone"))
    df = _bind(df, _epoch=F.when(F.col("_t").rlike(r"^\d+(\.\d+)?$"), epoch), _local=local, _named=F.when(~stated & F.col("_named_zone"), F.col("_iana")), _offset=F.when(stated, F.col("_minutes")))
    return _bind(df, _bad=F.col("_epoch").isNull() & (F.col("_local").isNull() | F.coalesce(bad_zone, F.lit(False))))


_WORK = ["_t", "_f", "_y", "_mo", "_d", "_half", "_h0", "_mi", "_s", "_us", "_z", "_iana", "_h", "_valid", "_minutes", "_named_zone", "_offset", "_epoch", "_local", "_named", "_bad"]


def resolve(df: DataFrame, clock: str) -> DataFrame:
    """From the columns of `with_parts` and a clock column: adds `utc_micros` and `utc_text`; drops the working columns."""
    zone = F.coalesce("_named", F.when(F.col("_offset").isNull() & ~F.col("_bad") & F.col("_epoch").isNull(), F.col(clock)))
    day = F.lit(86_400_000_000)
    df = _bind(df, _zone=zone)
    # The clock's offsets a day before and a day after; the local time is fine if exactly one of the instants reads so on the clock.
    has = F.col("_zone").isNotNull() & F.col("_local").isNotNull()
    before, after = F.when(has, _local(F.col("_local") - day, F.col("_zone")) - (F.col("_local") - day)), F.when(has, _local(F.col("_local") + day, F.col("_zone")) - (F.col("_local") + day))
    df = _bind(df, _u1=F.col("_local") - before, _u2=F.col("_local") - after)
    ok1, ok2 = F.when(has, _local(F.col("_u1"), F.col("_zone")) == F.col("_local")), F.when(has, _local(F.col("_u2"), F.col("_zone")) == F.col("_local"))
    df = _bind(df, _ok1=ok1, _ok2=ok2)
    micros = (
        F.when(F.col("_bad"), None)
        .when(F.col("_epoch").isNotNull(), F.col("_epoch"))
        .when(F.col("_offset").isNotNull(), F.col("_local") - F.col("_offset").cast("long") * 60_000_000)
        .when(F.col("_ok1") & F.col("_ok2") & (F.col("_u1") != F.col("_u2")), None)
        .when(F.col("_ok1"), F.col("_u1"))
        .when(F.col("_ok2"), F.col("_u2"))
    )
    df = _bind(df, utc_micros=micros)
    text = (
        F.when(F.coalesce(F.col("_t"), F.lit("")) == "", None)
        .when(F.col("utc_micros").isNotNull(), utc_text(F.col("utc_micros")))
        .when(F.col("_bad") | F.col("_zone").isNull(), "unreadable")
        .when(F.col("_ok1") & F.col("_ok2"), "ambiguous")
        .otherwise("nonexistent")
    )
    return _bind(df, utc_text=text).drop(*_WORK, "_zone", "_u1", "_u2", "_ok1", "_ok2")


def estimate_zones(rows: DataFrame, source: str, local: str, ingested: str, candidates: list[str] | None = None, usual_lag_s: float | None = None, max_lag_s: int = 14 * 86_400) -> DataFrame:
    """The clock of each source whose values carry no zone: columns `source`, `clock_zone`, `violations`, `n_rows`.

    Each candidate offset history turns the local microseconds (`local`) into instants; a violation is an instant after the
    row was taken in (`ingested`, UTC microseconds), more than `max_lag_s` before it, or off the usual lag (that of values whose zone is stated,
    if known) by more than `TOLERANCE_S`, or a local time that the history skips. The history with the fewest violations wins, then the one whose
    median lag is nearest to the usual (if that isn't known, to zero by half hours), then a common one, then the first by name. All known zones
    are tried unless `candidates` are given. If even the best history violates most rows, the source stays unresolved: its `clock_zone` is NULL.
    One partial aggregate per (source, candidate): a source that holds most rows shuffles no more than any other.
    Rows without a source, time or ingestion time are no evidence; a source without evidence gets no row.
    """
    base = rows.select(F.col(source).alias("source"), F.col(local).alias("l"), F.col(ingested).alias("g")).where("source is not null and l is not null and g is not null")
    if candidates is None:
        first = base.agg(F.min("l").alias("l")).collect()[0]["l"]  # one number
        candidates = distinct_histories(base.sparkSession, first - 2 * 86_400_000_000 if first is not None else 0)
    tried = base.withColumn("clock_zone", F.explode(F.array(*map(F.lit, candidates))))
    tried = tried.withColumn("u", F.unix_micros(F.to_utc_timestamp(F.timestamp_micros("l"), F.col("clock_zone"))))
    lag = (F.col("g") - F.col("u")) / 1e6
    far = F.lit(False) if usual_lag_s is None else F.abs(lag - usual_lag_s) > TOLERANCE_S
    wrong = far | (lag < -60) | (lag > max_lag_s) | (_local(F.col("u"), F.col("clock_zone")) != F.col("l"))
    each = tried.groupBy("source", "clock_zone").agg(F.count_if(wrong).alias("violations"), F.abs(F.percentile_approx(lag, 0.5) - (usual_lag_s or 0.0)).alias("lag"), F.count("*").alias("n_rows"))
    near = F.floor(F.col("lag") / 1800).cast("double") if usual_lag_s is None else F.round("lag", 3)
    best = each.groupBy("source").agg(F.min_by(F.struct("clock_zone", "violations", "n_rows"), F.struct("violations", near, ~F.col("clock_zone").isin(*COMMON_ZONES), F.round("lag", 3), "clock_zone")).alias("b"))
    zone = F.when(F.col("b.violations") * 2 <= F.col("b.n_rows"), F.col("b.clock_zone")).alias("clock_zone")
    return best.select("source", zone, "b.violations", "b.n_rows")


def without_zone(parts: DataFrame) -> DataFrame:
    """Readable values without a zone."""
    return parts.where("_local is not null and _offset is null and _named is null and not _bad and _epoch is null")


def usual_lag(parts: DataFrame, ingested: str = "_g") -> float | None:
    """The median of seconds from the values whose zone is stated to their ingestion: one number."""
    instant = F.coalesce("_epoch", F.col("_local") - F.col("_offset").cast("long") * 60_000_000)
    lag = F.when(~F.col("_bad"), (F.col(ingested) - instant) / 1e6)
    return parts.agg(F.percentile_approx(lag, 0.5).alias("m")).collect()[0]["m"]


def normalize(df: DataFrame, columns: list[str], source: str, clocks: DataFrame, ingested: str | None = None, key: str = "id") -> DataFrame:
    """Long form of the timestamp columns: `key`, `field_name`, `raw_text`, `utc_micros`, `utc_text`, one row per row and column.

    `clocks` has `source`, `clock_zone`, `day_order`. A source without a stated clock gets one by `estimate_zones` from the column
    `ingested` (ISO text in UTC); a source for which that isn't possible leaves its zone-less values unreadable.
    """
    from ..session import small_side

    spark = df.sparkSession
    zones = known_zones(spark)
    kept = df.select(F.col(key), F.col(source).alias("_source"), *([F.col(ingested).alias("_ingested")] if ingested else []), *[F.col(c).alias(f"_c{i}") for i, c in enumerate(columns)])
    fields = F.array(*[F.struct(F.lit(c).alias("field_name"), F.col(f"_c{i}").alias("raw_text")) for i, c in enumerate(columns)])
    # The list of fields is no constant, so that the scan isn't collapsed with the exploded expressions.
    long = kept.select(key, "_source", *(["_ingested"] if ingested else []), F.inline(fields))
    stated = small_side(clocks.where("source is not null").groupBy("source").agg(F.min("clock_zone").alias("_stated"), F.min("day_order").alias("_order")))
    long = with_parts(long.join(stated, long["_source"] == stated["source"], "left").drop("source"), "raw_text", "_order", zones)
    without = kept.select("_source").where("_source is not null").distinct().join(stated.where("_stated is not null").select(F.col("source").alias("_source")), "_source", "left_anti") if ingested else None
    if ingested and not without.isEmpty():
        # The last column is the one that is written when a row is taken in.
        seen = long.where(F.col("field_name") == columns[-1]).withColumn("_g", F.unix_micros(F.try_to_timestamp(F.concat("_ingested", F.lit("Z")))))
        found = small_side(estimate_zones(without_zone(seen).where("_stated is null"), "_source", "_local", "_g", usual_lag_s=usual_lag(seen)).select("source", F.col("clock_zone").alias("_estimated")))
        long = long.join(found, long["_source"] == found["source"], "left").withColumn("_clock", F.coalesce("_stated", "_estimated"))
    else:
        long = long.withColumn("_clock", F.col("_stated"))
    return resolve(long, "_clock").select(key, "field_name", "raw_text", "utc_micros", "utc_text")


def not_canonical(raw: Column, text: Column) -> Column:
    """Values that aren't already a valid `YYYY-MM-DDThh:mm:ssZ`; NULL, empty and blank ones are no case."""
    return text.isNotNull() & ~(raw.rlike(r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}Z$") & (text != "unreadable"))
