"""Dates, durations, numbers, hashes and JSON as expressions."""

from __future__ import annotations

from email.utils import parsedate_to_datetime

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType


def vtt_seconds(text: Column) -> Column:
    """Seconds of (H:)MM:SS[.,]mmm; NULL if minutes or seconds reach 60."""
    p = r"^\s*(?:(\d{1,4}):)?(\d{1,2}):(\d{2})[.,](\d{3})\s*$"
    h, m, s, ms = (F.regexp_extract(text, p, i).try_cast("int") for i in (1, 2, 3, 4))
    return F.when((m < 60) & (s < 60), F.coalesce(h, F.lit(0)) * 3600 + m * 60 + s + ms / F.lit(1000.0))


def vtt_text(seconds: Column) -> Column:
    """HH:MM:SS.mmm, rounded half to even, not below zero."""
    ms = F.greatest(F.bround(seconds * 1000).cast("long"), F.lit(0))
    return F.format_string("%02d:%02d:%02d.%03d", F.floor(ms / 3_600_000), F.floor(ms / 60_000) % 60, F.floor(ms / 1000) % 60, ms % 1000)


def duration_seconds(text: Column) -> Column:
    """H:M:S, M:S or seconds. Of texts with colons, parts that aren't digits are dropped before they are counted, and one part alone is none; else 0."""
    t = F.trim(F.coalesce(text, F.lit("")))
    parts = F.transform(F.filter(F.split(t, ":"), lambda x: x.rlike(r"^\d+$")), lambda x: x.try_cast("long"))
    at = lambda i: F.get(parts, i)
    several = F.when(F.size(parts) == 3, at(0) * 3600 + at(1) * 60 + at(2)).when(F.size(parts) == 2, at(0) * 60 + at(1))
    return F.coalesce(F.when(F.contains(t, F.lit(":")), several).otherwise(at(0)), F.lit(0)).cast("long")


@F.pandas_udf(StringType())
def rfc2822_iso(text: pd.Series) -> pd.Series:
    """ISO text of an RFC 2822 date with its own offset; '' if it is none."""

    def one(v):
        try:
            return parsedate_to_datetime(v).isoformat()
        except (TypeError, ValueError, IndexError):
            return ""

    return text.map(one)


def compact_date(text: Column) -> Column:
    """`YYYYMMDD` as ISO text at midnight UTC; '' otherwise."""
    day = F.try_to_date(text, "yyyyMMdd")
    return F.when(text.rlike(r"^\d{8}$") & day.isNotNull(), F.concat(day.cast("string"), F.lit("T00:00:00+00:00"))).otherwise("")


def epoch_iso(seconds: Column) -> Column:
    """Seconds since 1970 as ISO text in UTC; '' for none, and for zero."""
    at = F.date_format(F.convert_timezone(None, F.lit("UTC"), F.timestamp_seconds(seconds).cast("timestamp_ntz")), "yyyy-MM-dd'T'HH:mm:ss")
    return F.when(F.coalesce(seconds, F.lit(0)) != 0, F.concat(at, F.lit("+00:00"))).otherwise("")


def inclusive_before(column: Column, bound: str) -> Column:
    """At or before a bound of ISO text; a bare day means all of that day. Comparison is of texts, as the column is kept."""
    if len(bound) == 10:
        import datetime

        return column < (datetime.date.fromisoformat(bound) + datetime.timedelta(days=1)).isoformat()
    return column <= bound


def truthy(text: Column) -> Column:
    """JSON text that isn't missing, empty, zero or false."""
    return text.isNotNull() & ~F.trim(text).isin("", '""', "[]", "{}", "null", "0", "0.0", "false")


def box_iou(a: Column, b: Column) -> Column:
    """Intersection over union of two boxes [x1, y1, x2, y2]; 0 for an empty union."""
    g = F.get
    w = F.greatest(F.lit(0.0), F.least(g(a, 2), g(b, 2)) - F.greatest(g(a, 0), g(b, 0)))
    h = F.greatest(F.lit(0.0), F.least(g(a, 3), g(b, 3)) - F.greatest(g(a, 1), g(b, 1)))
    area = lambda x: (g(x, 2) - g(x, 0)) * (g(x, 3) - g(x, 1))
    union = area(a) + area(b) - w * h
    return F.when(union > 0, w * h / union).otherwise(0.0)


def box_distance(a: Column, b: Column) -> Column:
    g = F.get
    x = (g(a, 0) + g(a, 2) - g(b, 0) - g(b, 2)) / 2
    y = (g(a, 1) + g(a, 3) - g(b, 1) - g(b, 3)) / 2
    return F.sqrt(x * x + y * y)


def mapped_box(box: Column, region: Column) -> Column:
    """A box [x1, y1, x2, y2] relative to a region of the frame as a box relative to the frame."""
    g = F.get
    w, h = g(region, 2) - g(region, 0), g(region, 3) - g(region, 1)
    return F.array(g(region, 0) + g(box, 0) * w, g(region, 1) + g(box, 1) * h, g(region, 0) + g(box, 2) * w, g(region, 1) + g(box, 3) * h)


def valid_box(box: Column) -> Column:
    """Four finite numbers within the frame, of positive width and height."""
    fine = F.forall(box, lambda x: x.isNotNull() & ~F.isnan(x) & x.between(0, 1))
    return F.coalesce((F.size(box) == 4) & fine & (F.get(box, 2) > F.get(box, 0)) & (F.get(box, 3) > F.get(box, 1)), F.lit(False))


def six_places(number: Column) -> Column:
    """A finite number with six decimal places, half to even; NULL for others."""
    return F.when(number.isNotNull() & ~F.isnan(number) & (F.abs(number) < float("inf")), F.bround(number, 6))


def overrun_band(end: Column, duration: Column, warn: float = 0.5, fail: float = 5.0) -> Column:
    """How captions that end after the media are judged: ok, warning, failure; NULL if either is unknown."""
    over = end - duration
    return F.when(over > fail, "failure").when(over > warn, "warning").when(over.isNotNull(), "ok")


def finite(number: Column, low: float, high: float) -> Column:
    return number.isNotNull() & ~F.isnan(number) & number.between(low, high)


def set_fingerprint(ids: Column) -> Column:
    """SHA-256 of the sorted distinct ids joined by line feeds: an aggregate, for sets whose size is stated (a batch); see `set_digest` for any size."""
    return F.sha2(F.array_join(F.array_sort(F.collect_set(ids)), "\n"), 256)


def set_digest(id_: Column) -> tuple[Column, Column, Column]:
    """(count, sum, xor) of the distinct rows' 60-bit hashes: aggregates of constant size that tell sets of any size apart; rows must be distinct."""
    h = F.conv(F.substring(F.sha2(id_, 256), 1, 15), 16, 10).cast("long")
    return F.count(id_), F.sum(h.cast("decimal(38,0)")).cast("string"), F.bit_xor(h)


def short_hash(*parts: Column, length: int = 20) -> Column:
    return F.substring(F.sha2(F.concat_ws("|", *parts), 256), 1, length)


def json_text(document: Column, *paths: str) -> Column:
    """The first of the paths that a JSON text has; '' for none and for invalid JSON."""
    return F.coalesce(*[F.get_json_object(document, p) for p in paths], F.lit(""))


def overrun(ends: Column, duration: Column, most: float = 2.0) -> Column:
    """struct(last, duration, over) if captions end too long after the media, else NULL."""
    last = F.array_max(ends)
    over = F.round(last - duration, 6)
    return F.when(over > most, F.struct(last.alias("last"), duration.alias("duration"), over.alias("over")))
