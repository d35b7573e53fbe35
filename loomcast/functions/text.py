"""Text expressions; parser-bound ones are Arrow-batched UDFs on the standard library."""

from __future__ import annotations

import base64
import html
import json
import re
import unicodedata
from html.parser import HTMLParser
from urllib.parse import quote, quote_plus

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

# Elements that end a line, elements dropped with their content, schemes and attributes that may carry code.
BREAKING = ("br", "p", "div", "li", "tr", "h1", "h2", "h3", "h4", "h5", "h6")
ACTIVE = ("script", "style", "iframe", "object", "embed", "form", "meta", "link")
SCHEMES = ("javascript", "vbscript", "data", "file")
LINKS = ("href", "src", "action", "formaction", "poster")
VOID = ("br", "hr", "img", "input", "source", "track", "wbr", "area", "base", "col", "meta", "link", "embed")


class _Parser(HTMLParser):
    def parse_marked_section(self, i, report=1):
        """`<![` before anything but a section's name is a comment up to the next `>`, as browsers read it; the library raises."""
        try:
            return super().parse_marked_section(i, report)
        except AssertionError:
            return self.parse_bogus_comment(i)


class _Plain(_Parser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.out: list[str] = []
        self.hidden = 0

    def handle_starttag(self, tag, attrs):
        self.hidden += tag in ("script", "style")
        if tag in BREAKING:
            self.out.append("\n")

    def handle_endtag(self, tag):
        if tag in ("script", "style"):
            self.hidden = max(0, self.hidden - 1)
        elif tag in BREAKING:
            self.out.append("\n")

    def handle_data(self, data):
        if not self.hidden:
            self.out.append(data)


def plain(value: str | None) -> str:
    if not value:
        return ""
    p = _Plain()
    p.feed(value)
    p.close()
    lines = [re.sub(r"[^\S\n]+", " ", x).strip() for x in "".join(p.out).split("\n")]
    return re.sub(r"\n{3,}", "\n\n", "\n".join(lines)).strip()


class _Safe(_Parser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=False)
        self.out: list[str] = []
        self.inside: list[str] = []

    def _tag(self, tag, attrs, close):
        if tag in ACTIVE:
            return
        kept = []
        for name, value in attrs:
            scheme = re.sub(r"[\s\x00-\x1f]+", "", html.unescape(value or "")).split(":")[0].lower()
            if name.startswith("on") or name in ("srcdoc", "style") or (name in LINKS and scheme in SCHEMES):
                continue
            kept.append(f" {name}" if value is None else f' {name}="{html.escape(value)}"')
        if not self.inside:
            self.out.append(f"<{tag}{''.join(kept)}{close}>")

    def handle_starttag(self, tag, attrs):
        if tag in ACTIVE and tag not in VOID:
            self.inside.append(tag)
        self._tag(tag, attrs, "")

    def handle_startendtag(self, tag, attrs):
        self._tag(tag, attrs, "/")

    def handle_endtag(self, tag):
        if tag in ACTIVE:
            if tag in self.inside:
                del self.inside[self.inside.index(tag) :]
        elif not self.inside and tag not in VOID:
            self.out.append(f"</{tag}>")

    def handle_data(self, data):
        if not self.inside:
            self.out.append(data)

    def handle_entityref(self, name):
        self.handle_data(f"&{name};")

    def handle_charref(self, name):
        self.handle_data(f"&#{name};")


def safe(value: str | None) -> str:
    p = _Safe()
    p.feed(value or "")
    p.close()
    return "".join(p.out)


def ocr(value: str | None, most: int = 500) -> str:
    """Recognised text: compatibility forms folded, control characters dropped, blanks joined, bounded."""
    t = "".join(c if c.isspace() or unicodedata.category(c)[0] != "C" else "" for c in unicodedata.normalize("NFKC", value or ""))
    return " ".join(t.split())[:most]


def _udf(function):
    @F.pandas_udf(StringType())
    def wrapped(column: pd.Series) -> pd.Series:
        return column.map(lambda v: function(None if pd.isna(v) else v))

    return wrapped


plain_text = _udf(plain)
sanitize_html = _udf(safe)
clean_ocr = _udf(ocr)


@F.pandas_udf(ArrayType(StringType()))
def _unescaped(lines: pd.Series) -> pd.Series:
    return lines.map(lambda x: None if x is None else [html.unescape(t) for t in x])


def clean_caption(text: Column) -> Column:
    """Caption text: tags taken off, entities resolved, blanks joined; no empty line and none that repeats the line before it.

    Lines and blanks are worked on in the JVM; only the table of entities is Python's, and only lines that may hold one go there.
    """
    lines = F.transform(F.split(F.regexp_replace(F.coalesce(text, F.lit("")), "\\r", ""), "\n"), lambda x: F.regexp_replace(x, "<[^>]+>", ""))
    lines = F.coalesce(_unescaped(F.when(F.exists(lines, lambda x: F.contains(x, F.lit("&"))), lines)), lines)
    lines = F.filter(F.transform(lines, lambda x: F.regexp_replace(F.regexp_replace(x, r"[ \t\f\x0b]+", " "), r"(?U)^\s+|\s+$", "")), lambda x: x != "")
    # A fold, because a lambda can't look back into what Python gave.
    once = F.aggregate(lines, F.array().cast("array<string>"), lambda out, x: F.when(F.coalesce(F.try_element_at(out, F.lit(-1)) == x, F.lit(False)), out).otherwise(F.concat(out, F.array(x))))
    return F.array_join(once, "\n")


def unwrap_cdata(text: Column) -> Column:
    """The body of the first CDATA section, or the trimmed text."""
    body = F.regexp_extract(text, r"(?s)<!\[CDATA\[(.*?)\]\]>", 1)
    return F.when(text.contains("<![CDATA["), F.trim(body)).otherwise(F.trim(text))


def safe_name(text: Column, most: int = 80) -> Column:
    """A file name of letters, digits and a few signs, cut, with the start of its hash so that cut names stay apart."""
    base = F.substring(F.regexp_replace(F.regexp_replace(F.coalesce(text, F.lit("")), r"[^A-Za-z0-9._-]+", "_"), r"^[._]+|[._]+$", ""), 1, most)
    return F.concat(F.when(base == "", F.lit("item")).otherwise(base), F.lit("_"), F.substring(F.sha2(F.coalesce(text, F.lit("")), 256), 1, 16))


def human_size(n: Column) -> Column:
    out = F.format_string("%.1f TB", n / float(1 << 40))
    for power, unit in ((30, "GB"), (20, "MB"), (10, "KB")):
        out = F.when(n < float(1 << (power + 10)), F.format_string(f"%.1f {unit}", n / float(1 << power))).otherwise(out)
    return F.when(F.coalesce(n, F.lit(0)) <= 0, "-").when(n < 1024, F.format_string("%d B", n.cast("long"))).otherwise(out)


def human_duration(seconds: Column) -> Column:
    s = F.floor(seconds).cast("long")
    h, m = F.floor(s / 3600), F.floor((s % 3600) / 60)
    return F.when(F.coalesce(s, F.lit(0)) <= 0, "-").when(h > 0, F.format_string("%d:%02d:%02d", h, m, s % 60)).otherwise(F.format_string("%d:%02d", m, s % 60))


def secret_forms(secret: str) -> list[str]:
    """A secret as it may be written: raw, in a URL (both ways), in JSON, in base64 (with and without padding); longest first."""
    raw = secret.encode()
    coded = [f(raw).decode() for f in (base64.b64encode, base64.urlsafe_b64encode)]
    forms = [secret, quote(secret, safe=""), quote_plus(secret, safe=""), json.dumps(secret)[1:-1], json.dumps(secret, ensure_ascii=False)[1:-1], *coded, *[c.rstrip("=") for c in coded]]
    return sorted({f for f in forms if f}, key=lambda f: (-len(f), f))


def any_needle(text: Column, needles: list[str]) -> Column:
    return F.exists(F.array(*map(F.lit, needles)), lambda n: F.contains(text, n))


def mask_needles(text: Column, needles: list[str], mask: str = "[redacted]") -> Column:
    """Every needle replaced, the longest first."""
    out = text
    for n in sorted(needles, key=len, reverse=True):
        out = F.replace(out, F.lit(n), F.lit(mask))
    return out


def first_mapped(items: Column, mapping: dict[str, str], default: str) -> Column:
    """The value of the first item that the mapping knows."""
    pairs = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])
    return F.coalesce(F.try_element_at(F.filter(F.transform(items, lambda g: F.try_element_at(pairs, g)), lambda v: v.isNotNull()), F.lit(1)), F.lit(default))


def content_range(text: Column) -> Column:
    """`bytes a-b/total` as struct(first, last, total); NULL unless a <= b < total."""
    p = r"^bytes (\d+)-(\d+)/(\d+)$"
    a, b, n = (F.regexp_extract(text, p, i).try_cast("long") for i in (1, 2, 3))
    return F.when((a <= b) & (b < n), F.struct(a.alias("first"), b.alias("last"), n.alias("total")))


# Extensions of media types, and those that a path may name itself.
ASSET_EXTENSIONS = {
    "image/jpeg": ".jpg", "image/png": ".png", "image/webp": ".webp", "image/gif": ".gif", "text/plain": ".txt", "text/html": ".html", "text/vtt": ".vtt", "application/json": ".json",
    "application/ld+json": ".json", "application/x-subrip": ".srt", "application/xml": ".xml",
}
PATH_EXTENSIONS = {x: x for x in (".jpg", ".png", ".webp", ".gif", ".txt", ".html", ".vtt", ".srt", ".json", ".xml")} | {".jpeg": ".jpg", ".htm": ".html"}


def _looked_up(key: Column, mapping: dict[str, str]) -> Column:
    return F.try_element_at(F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv]), key)


def asset_extension(media_type: Column, url: Column) -> Column:
    """The extension of an asset by its media type (without parameters), else by its path if that is a known one, else `.bin`."""
    kind = F.lower(F.trim(F.split_part(F.coalesce(media_type, F.lit("")), F.lit(";"), F.lit(1))))
    own = F.lower(F.regexp_extract(F.coalesce(F.try_parse_url(url, F.lit("PATH")), F.lit("")), r"[^/](\.[^./]*)$", 1))
    return F.coalesce(_looked_up(kind, ASSET_EXTENSIONS), _looked_up(own, PATH_EXTENSIONS), F.lit(".bin"))


def referer(url: Column, domains: dict[str, str]) -> Column:
    """The page that stands for a media URL's host: of the first domain that the host contains, else the host's own."""
    at = lambda part: F.coalesce(F.try_parse_url(url, F.lit(part)), F.lit(""))
    host = F.lower(at("AUTHORITY"))
    out = F.concat(at("PROTOCOL"), F.lit("://"), at("AUTHORITY"), F.lit("/"))
    for domain, page in reversed(domains.items()):
        out = F.when(F.contains(host, F.lit(domain)), page).otherwise(out)
    return out
