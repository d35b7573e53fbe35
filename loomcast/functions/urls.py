"""URL expressions. Each takes and gives Columns and stays in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def part(url: Column, name: str) -> Column:
    """A part of a URL, NULL if the text is none."""
    return F.try_parse_url(url, F.lit(name))


def host(url: Column) -> Column:
    return F.lower(F.coalesce(part(url, "HOST"), F.lit("")))


def _bare(url: Column, schemes: str) -> Column:
    """Scheme, host (lower-cased), port and path of a URL whose scheme matches; '' otherwise. Brackets of IPv6 hosts stay."""
    clean = F.regexp_replace(F.trim(F.coalesce(url, F.lit(""))), r"[?#].*$", "")
    pattern = rf"^(?i)({schemes})://(?:[^/]*@)?(\[[^\]/]*\]|[^/:\s]+)(:\d+)?(/.*)?$"
    part_of = lambda i: F.coalesce(F.regexp_extract(clean, pattern, i), F.lit(""))
    return F.when(clean.rlike(pattern), F.concat(F.lower(part_of(1)), F.lit("://"), F.lower(part_of(2)), part_of(3), part_of(4))).otherwise("")


def redact_web(url: Column) -> Column:
    """http(s) alone, without user, query and fragment."""
    return _bare(url, "https?")


def redact_any(url: Column) -> Column:
    """Any scheme with a host, without user, query and fragment."""
    return _bare(url, r"[A-Za-z][\w+.-]*")


def redact_secure(url: Column) -> Column:
    """https alone."""
    return _bare(url, "https")


def redact_in_text(text: Column, limit: int = 2000) -> Column:
    """Every URL in a text without user, query and fragment; the text cut to a length."""
    bare = F.regexp_replace(F.coalesce(text, F.lit("")), r"(https?://)[^/@\s]*@", "$1")
    return F.substring(F.regexp_replace(bare, r"(https?://[^\s?#\"'<>]+)[?#][^\s\"'<>]*", "$1"), 1, limit)


def video_id_short(url: Column) -> Column:
    """The id of 11 characters in a watch, short, embed or bare path of the one video platform."""
    h, p = host(url), F.coalesce(part(url, "PATH"), F.lit(""))
    found = F.coalesce(
        F.when(h.isin("youtu.be"), F.regexp_extract(p, r"^/([\w-]{11})(?:/|$)", 1)),
        F.when(h.rlike(r"(^|\.)youtube\.com$") & (p == "/watch"), F.regexp_extract(F.coalesce(part(url, "QUERY"), F.lit("")), r"(?:^|&)v=([\w-]{11})(?:&|$)", 1)),
        F.when(h.rlike(r"(^|\.)youtube\.com$"), F.regexp_extract(p, r"^/(?:shorts|embed|live|v)/([\w-]{11})(?:/|$)", 1)),
    )
    return F.when(part(url, "USERINFO").isNull(), F.nullif(found, F.lit("")))


def video_id_long(text: Column) -> Column:
    """The id `BV` and ten letters or digits of the other platform, in a path or bare."""
    return F.nullif(F.regexp_extract(text, r"(?:^|/)(BV[0-9A-Za-z]{10})(?:[/?#]|$)", 1), F.lit(""))


def diagnose(url: Column, suffixes: list[str]) -> Column:
    """Why a URL isn't taken, first reason first: empty, scheme, credentials, port, host; else accepted."""
    allowed = F.lit(False)
    for s in suffixes:
        allowed = allowed | (host(url) == s) | host(url).endswith("." + s)
    port = F.regexp_extract(F.coalesce(part(url, "AUTHORITY"), F.lit("")), r":(\d+)$", 1)
    return (
        F.when(F.coalesce(F.trim(url), F.lit("")) == "", "empty")
        .when(F.coalesce(F.lower(part(url, "PROTOCOL")), F.lit("")) != "https", "scheme")
        .when(part(url, "USERINFO").isNotNull(), "credentials")
        .when(~port.isin("", "443"), "port")
        .when(~allowed, "host")
        .otherwise("accepted")
    )


def item_identifier(url: Column, first: list[str]) -> Column:
    """The second segment of a path whose first one is one of these, NULL otherwise."""
    segments = F.filter(F.split(F.coalesce(part(url, "PATH"), F.lit("")), "/"), lambda s: s != "")
    return F.when(F.get(segments, 0).isin(*first), F.get(segments, 1))


def path_identifier(url: Column, place: int) -> Column:
    """The n-th segment of a path (from 0), NULL if missing."""
    return F.nullif(F.get(F.filter(F.split(F.coalesce(part(url, "PATH"), F.lit("")), "/"), lambda s: s != ""), place), F.lit(""))
