"""Text that was read in a wrong character encoding.

Characters are mapped back to the bytes of the code page in which they were seen; an automaton over those bytes (written as a regular
expression over the code page's characters) finds the maximal spans that are well formed in the true encoding; only those spans are
decoded. The step is repeated, because text may have been damaged more than once.

Defined results: NULL and empty texts are undamaged; a text with U+FFFD, C1 controls or private-use characters left is damaged though it
can't be restored (`restored` is NULL); a span is left alone if what it decodes to is no likely text, so names like `MANHÃ` or
`«café…»` stay as they are.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SINGLE = ("cp1252", "latin-1", "cp1250", "cp1251", "cp1254", "cp437", "cp850", "cp866", "koi8-r", "mac_roman", "iso8859-2", "iso8859-15")
DOUBLE = ("gbk", "big5", "cp932", "euc_jp", "cp949")
#: Multibyte encodings whose bytes may have been read in a single-byte page, and single-byte Cyrillic ones.
TRUE_DOUBLE = ("gbk", "cp932", "euc_jp", "big5", "cp949")
TRUE_JAPANESE = ("cp932", "euc_jp")
TRUE_CYRILLIC = ("cp1251", "koi8-r", "cp866")


@lru_cache(None)
def bytes_of(codec: str) -> dict[str, int]:
    """Characters of a single-byte code page and their bytes; bytes that it leaves undefined are the C1 controls, as readers make them."""
    out = {}
    for b in range(0x80, 0x100):
        try:
            out.setdefault(bytes([b]).decode(codec), b)
        except UnicodeDecodeError:
            out.setdefault(chr(b), b)
    if codec == "cp1252":  # readers differ on these; both are seen side by side
        for b in range(0x80, 0xA0):
            out.setdefault(chr(b), b)
    return out


@lru_cache(None)
def chars_of(codec: str) -> dict[int, str]:
    out: dict[int, str] = {}
    for c, b in bytes_of(codec).items():
        out.setdefault(b, c)
    return out


def _class(codec: str, low: int, high: int) -> str:
    return "[" + "".join(re.escape(c) for c, b in bytes_of(codec).items() if low <= b <= high) + "]"


@lru_cache(None)
def utf8_spans(codec: str) -> re.Pattern:
    """The automaton of well-formed multibyte UTF-8 over the characters of a code page: maximal spans."""
    c = lambda a, b: _class(codec, a, b)
    t = c(0x80, 0xBF)
    return re.compile(
        f"(?:{c(0xC2, 0xDF)}{t}|{c(0xE0, 0xE0)}{c(0xA0, 0xBF)}{t}|{c(0xE1, 0xEC)}{t}{t}|{c(0xED, 0xED)}{c(0x80, 0x9F)}{t}|{c(0xEE, 0xEF)}{t}{t}"
        f"|{c(0xF0, 0xF0)}{c(0x90, 0xBF)}{t}{t}|{c(0xF1, 0xF3)}{t}{t}{t}|{c(0xF4, 0xF4)}{c(0x80, 0x8F)}{t}{t})+"
    )


UTF8_BYTES = re.compile(
    rb"(?:[\xC2-\xDF][\x80-\xBF]|\xE0[\xA0-\xBF][\x80-\xBF]|[\xE1-\xEC\xEE\xEF][\x80-\xBF]{2}|\xED[\x80-\x9F][\x80-\xBF]|\xF0[\x90-\xBF][\x80-\xBF]{2}|[\xF1-\xF3][\x80-\xBF]{3}|\xF4[\x80-\x8F][\x80-\xBF]{2})+"
)


#: Where the national standards keep their first-level characters: the encoding, its first and last rows.
LEVELS = {"gbk": ("gb2312", 0xB0, 0xD7), "euc_jp": ("euc_jp", 0xB0, 0xCF), "cp932": ("euc_jp", 0xB0, 0xCF), "big5": ("big5", 0xA4, 0xC6)}


@lru_cache(None)
def first_level(encoding: str) -> frozenset[str]:
    """The first-level characters of an encoding's standard (its code table puts the common ones in front), and kana and punctuation."""
    codec, first, last = LEVELS[encoding]
    trails = [*range(0x40, 0x7F), *range(0xA1, 0xFF)] if codec == "big5" else range(0xA1, 0xFF)
    out = {chr(c) for c in range(0x3001, 0x3100)} | {chr(c) for c in range(0xFF01, 0xFF5F)}
    for a in range(first, last + 1):
        for b in trails:
            try:
                out.add(bytes([a, b]).decode(codec))
            except UnicodeDecodeError:
                pass
    return frozenset(out)


@lru_cache(None)
def frequent_hanzi() -> frozenset[str]:
    """Those of all the standards."""
    return frozenset().union(*map(first_level, LEVELS))


def _cjk(c: str) -> bool:
    return "぀" <= c <= "ヿ" or "㐀" <= c <= "鿿" or "豈" <= c <= "﫿"


def _wide(c: str) -> bool:
    return _cjk(c) or "　" <= c <= "〿" or "！" <= c <= "｠" or "가" <= c <= "힣"


def _kind(c: str) -> str:
    if c < "\x80":
        return "a"
    if c < "\xa0":
        return "1" if c == "\x85" else "x"
    if c <= "ſ":
        return "l"
    if _wide(c):
        return "w"
    if "Ѐ" <= c <= "ӿ":
        return "c"
    if "Ͱ" <= c <= "Ͽ":
        return "g"
    if "‐" <= c <= "⁞" or "₠" <= c <= "₿" or "℀" <= c <= "⅏" or "←" <= c <= "⇿" or "☀" <= c <= "➿" or c >= "\U0001d000" and c <= "\U0001faff" or c in "´ˆ˜ƒ•" or "●" == c or "★" == c:
        return "p"
    return "?"


def _plausible_utf8(codec: str, text: str, found: list[tuple[int, int, str]]) -> list[tuple[int, int, str]]:
    """Of the spans (start, end, decoded) those that are likely text."""
    # Only non-Latin code pages make whole words out of ordinary letters: there the letters left outside the spans speak against it.
    if codec in ("cp1251", "koi8-r", "cp866", "iso8859-5"):
        inside = sum(e - s for s, e, _ in found)
        letters = sum("Ѐ" <= c <= "ӿ" for c in text)
        if inside < 0.85 * letters:
            found = [f for f in found if len(f[2]) >= 4]
    out = []
    total_wide = sum(_wide(c) for _, _, d in found for c in d)
    total_other = sum(_kind(c) in "cg" for _, _, d in found for c in d)
    for s, e, d in found:
        kinds = [_kind(c) for c in d]
        if "?" in kinds and kinds.count("?") * 4 > len(kinds):
            continue
        around = text[max(0, s - 1) : s] + text[e : e + 1]
        if "w" in kinds and total_wide < 2 and len(d) < 2 and not any(map(_wide, around)):
            continue  # `é…»` is no hanzi
        if set(kinds) <= set("cg") and total_other < 2:
            continue
        out.append((s, e, d))
    return out


def _from_single(codec: str, text: str) -> str | None:
    """UTF-8 that was read in a single-byte code page: its spans decoded, or None without a likely one."""
    pattern = utf8_spans(codec)
    if not pattern.search(text):
        return None
    table, found = bytes_of(codec), []
    for m in pattern.finditer(text):
        found.append((m.start(), m.end(), bytes(table[c] for c in m[0]).decode()))
    if not (found := _plausible_utf8(codec, text, found)):
        return None
    out, at = [], 0
    for s, e, d in found:
        out += [text[at:s], d]
        at = e
    return "".join([*out, text[at:]])


def _covered(codec: str, text: str) -> float:
    """The share of a text's characters beyond ASCII that well-formed spans take up."""
    return sum(len(m[0]) for m in utf8_spans(codec).finditer(text)) / max(1, sum(not c.isascii() and not _wide(c) for c in text))


_RUN = {}


def _runs(codec: str) -> re.Pattern:
    """Runs of a code page's upper half, with the ASCII characters between that may be second bytes."""
    if codec not in _RUN:
        h = _class(codec, 0x80, 0xFF)
        _RUN[codec] = re.compile(f"{h}(?:[@-~]?{h})*[@-~]?")
    return _RUN[codec]


def _eastern(c: str) -> bool:
    return _wide(c) or "｡" <= c <= "ﾟ" or "" <= c <= ""


def _share(text: str, encoding: str | None = None) -> float:
    """Of the wide characters those that are common, in any standard or in one encoding's."""
    wide = [c for c in text if _eastern(c)]
    good = first_level(encoding) if encoding in LEVELS else frequent_hanzi()
    return sum(c in good for c in wide) / len(wide) if wide else 0.0


def _well_cased(text: str) -> bool:
    """Words of a bicameral script: capitals only in front, or throughout."""
    words = re.findall(r"[Ѐ-ӿ]{2,}", text)
    return bool(words) and sum(w[1:].islower() or w.isupper() for w in words) >= 0.8 * len(words) and not all(w.isupper() for w in words)


_HARD = re.compile("[\x80-\x84\x86-\x9f]")


def _from_legacy(text: str) -> str | None:
    """Bytes of a legacy encoding that were read in a Western code page: its runs decoded, or None."""
    for codec in ("cp1252", "latin-1"):
        table = bytes_of(codec)
        runs = [m for m in _runs(codec).finditer(text) if sum(c in table for c in m[0]) >= 3]
        if not runs:
            continue
        best = None
        # Adjacent bytes of the upper half are rare in Western text; controls rarer still.
        dense = [m for m in runs if re.search(_class(codec, 0x80, 0xFF) + "{4}", m[0]) or len(_HARD.findall(m[0])) >= 2 or m[0].count("ƒ") + m[0].count("‚") >= 2]
        long = [m for m in re.finditer(_class(codec, 0xA8, 0xFF) + "{3,}", text)]
        if long:
            whole = list(re.finditer(_class(codec, 0xA8, 0xFF) + "+", text))
            for true in TRUE_CYRILLIC:
                parts = []
                for m in whole:
                    try:
                        parts.append((m.start(), m.end(), bytes(table[c] for c in m[0]).decode(true)))
                    except UnicodeDecodeError:
                        pass
                joined = " ".join(d for _, _, d in parts)
                if parts and sum("А" <= c <= "я" or c in "ёЁ" for c in joined) >= 0.85 * len(joined.replace(" ", "")) and _well_cased(joined):
                    best = (1, parts)
                    break
        if dense and best is None:
            for true in TRUE_DOUBLE:
                good, parts = 0, []
                for m in dense:
                    raw = bytes(table.get(c, ord(c)) for c in m[0])
                    for cut in (len(raw), len(raw) - 1):
                        try:
                            d = raw[:cut].decode(true) + raw[cut:].decode("latin-1")
                        except UnicodeDecodeError:
                            continue
                        if sum(_cjk(c) for c in d) >= 2 and (share := _share(d)) >= 0.5:
                            parts.append((m.start(), m.end(), d))
                            # Kana are in the same places of the Chinese and the Japanese tables; if the characters beside them are as likely in both, it is Japanese.
                            kana = true in TRUE_JAPANESE and any("\u3041" <= c <= "\u3096" or "\u30a1" <= c <= "\u30fa" for c in d)
                            good += _share(d, true) * sum(map(_wide, d)) * (1.01 if kana else 1)
                        break
                if parts and (best is None or good > best[0]):
                    best = (good, parts)
        if best:
            out, at = [], 0
            for s, e, d in sorted(best[1]):
                out += [text[at:s], d]
                at = e
            return "".join([*out, text[at:]])
    return None


_BROKEN = re.compile("[\u0400-\u04ff][¤§©«®°±µ¶·»Ґ][\u0400-\u04ff]")


def _from_cyrillic(text: str) -> str | None:
    """One Cyrillic code page that was read as another, or None."""
    if (_well_cased(text) and not _BROKEN.search(text)) or sum("\u0400" <= c <= "\u04ff" or "\u2500" <= c <= "\u259f" for c in text) < 4:
        return None
    best = None
    for seen in TRUE_CYRILLIC:
        table = bytes_of(seen)
        for true in TRUE_CYRILLIC:
            if seen != true and sum(c in table for c in text) >= 0.8 * sum(not c.isascii() for c in text):
                back = chars_of(true)
                d = "".join(back[table[c]] if c in table else c for c in text)
                if _well_cased(d) and (best is None or _oddness(d) < _oddness(best)):
                    best = d
    return best


#: Signs of ill-formed Western words: a capital or a symbol inside, a symbol where a word ends, a lone ñ for a dash, íÈ for an apostrophe.
_ILL = re.compile(
    "(?<=[a-zà-öø-ÿ])[À-ÖØ-ÞŠŽŒŸ]|(?<=[^\\W\\d_])[^\\w\\s’‘'ʼ.,:;!?/+&–—\\-|*“”«»()\\[\\]™®©·•…=_~@#%](?=[^\\W\\d_])"
    "|(?<=[a-z])[‚ƒ„†‡‰‹¢£¤¥¦§¨¬¯±¸¼½¾¿¡](?!\\w)|(?<!\\w)[ñÑ](?!\\w)|(?<!\\w)[‡∫√∑∏Ω](?!\\w)|\\b[dl]í(?=[hÀ-ÖØ-Þ])|(?<!\\w)ì(?=\\w)|(?<!\\w)´(?=\\w)|n∫|(?<!\\w)‡(?!\\w)|(?<=[a-z])[ˆ˚˜](?=[a-z])|(?<=[a-km-z])·(?=[a-z])|(?<=l)·(?=[a-km-z])|(?<=[a-z])[ˆ˚](?![a-z])"
)
#: A name and an apostrophe read as í: only where the rest is English, as other languages have words that end so.
_POSSESSIVE = re.compile(r"\b[A-Z]\w+ís\b")
#: Most labelled samples that the letter statistics are taken from.
MAX_SAMPLES = 20_000
GRAM = 3


def letter_model(samples: list[tuple[str, str]]) -> dict[str, dict[str, float]]:
    """Per language of the Latin script the log probabilities of its sequences of three letters (under '' that of an unseen one), from labelled texts (language, text)."""
    counts: dict[str, Counter] = {}
    for lang, text in samples:
        if sum(c.isascii() for c in text) > 0.7 * len(text):
            counts.setdefault(lang, Counter()).update(_letters(text))
    seen = len({g for c in counts.values() for g in c}) + 1
    return {lang: {g: math.log((n + 0.1) / (c.total() + 0.1 * seen)) for g, n in c.items()} | {"": math.log(0.1 / (c.total() + 0.1 * seen))} for lang, c in counts.items()}


def _letters(text: str) -> list[str]:
    t = " " + " ".join(re.findall(r"[^\W\d_]+", text.lower())) + " "
    return [t[i : i + GRAM] for i in range(len(t) - GRAM + 1)]


def _is_english(text: str, model: dict[str, dict[str, float]]) -> bool:
    """Whether English explains a text's letters better than every other language of the samples."""
    scores = {lang: sum(p.get(g, p[""]) for g in _letters(text)) for lang, p in model.items()}
    return bool(scores) and max(scores, key=scores.get) == "en"


#: Western pages taken for one another: (seen, true).
WESTERN = (("mac_roman", "cp1252"), ("cp1252", "mac_roman"), ("cp1252", "cp850"), ("cp1252", "cp437"), ("cp850", "cp1252"), ("cp437", "cp1252"))


def _ill(text: str, model: dict[str, dict[str, float]]) -> int:
    possessive = sum(not c.isascii() for c in text) == 1 and _POSSESSIVE.search(text) and _is_english(text.replace("í", " "), model)
    return len(_ILL.findall(text)) + bool(possessive)


def _from_western(text: str, model: dict[str, dict[str, float]]) -> str | None:
    """One Western code page that was read as another: the words become well formed, or None."""
    if any(map(_eastern, text)) and not _ILL.search(text) or not (before := _ill(text, model)):
        return None
    best = None
    for seen, true in WESTERN:
        table, back = bytes_of(seen), chars_of(true)
        if all(c.isascii() or c in table or _wide(c) for c in text):
            d = "".join(back[table[c]] if c in table else c for c in text)
            if d != text and not _ill(d, model) and all(_kind(c) in "alpw" for c in d) and not re.search("[¤¦¨¬¯±²³¸¹¼½¾÷×]", d) and (best is None or _oddness(d) < _oddness(best)):
                best = d
    return best if before else None


_WIDE_RUN = re.compile("[^\x00-\x7f]+")


def _from_double(text: str) -> str | None:
    """Text that was read in an East Asian encoding though it was another: its runs decoded, or None."""
    own = _share(text)
    best = None
    for seen in ("gb18030", "big5", "cp932", "euc_jp", "cp949"):
        for true in ("utf-8", "gbk", "cp932", "euc_jp", "big5"):
            if true == seen or (seen, true) == ("gb18030", "gbk"):
                continue
            out, at, decoded, three, lost = [], 0, "", 0, 0
            for m in _WIDE_RUN.finditer(text):
                if sum(map(_eastern, m[0])) < 2:
                    continue
                try:
                    raw = m[0].encode(seen)
                except UnicodeEncodeError:
                    raw = b"".join(_encoded(c, seen) for c in m[0])
                if true == "utf-8":
                    spans = [x for x in UTF8_BYTES.finditer(raw) if x.end() - x.start() >= 5]
                    covered = sum(x.end() - x.start() for x in spans)
                    if not spans or covered < 0.5 * len(raw):
                        continue
                    d, b = "", 0
                    for x in spans:
                        d += raw[b : x.start()].decode(seen, "replace") + x[0].decode()
                        b = x.end()
                        three += sum(_wide(c) or "Ѐ" <= c <= "ӿ" or "‐" <= c <= "⁞" for c in x[0].decode())
                    d += raw[b:].decode(seen, "replace")
                    lost += len(raw) - covered
                else:
                    try:
                        d = raw.decode(true)
                    except UnicodeDecodeError:
                        continue
                out += [text[at : m.start()], d]
                at = m.end()
                decoded += d
            if not decoded:
                continue
            share = _share(decoded)
            if true == "utf-8":
                if three < 2:
                    continue
                score = 2 + share - lost / 100
            else:
                if sum(map(_cjk, decoded)) < 3 or share < 0.7 or share < own + 0.4:
                    continue
                score = share
            if best is None or score > best[0]:
                best = (score, "".join([*out, text[at:]]))
    return best[1] if best else None


def _whole_utf8(text: str) -> str | None:
    """UTF-8 that was read in an East Asian encoding, if every run of the text, at least four characters long, is well formed throughout."""
    for seen in ("gb18030", "big5", "cp932", "euc_jp", "cp949"):
        try:
            runs = [(m, m[0].encode(seen).decode("utf-8")) for m in _WIDE_RUN.finditer(text) if sum(map(_eastern, m[0])) > 1]
        except (UnicodeEncodeError, UnicodeDecodeError):
            continue
        if runs and all(len(m[0]) >= 4 and _share(d) >= 0.5 and sum(map(_wide, d)) >= 2 for m, d in runs):
            out, at = [], 0
            for m, d in runs:
                out += [text[at : m.start()], d]
                at = m.end()
            return "".join([*out, text[at:]])
    return None


def _encoded(c: str, codec: str) -> bytes:
    try:
        return c.encode(codec)
    except UnicodeEncodeError:
        return b"\xff"


_PRIVATE = re.compile("[-]")
_LOST = re.compile("[�-\x80-\x84\x86-\x9f]")
_EASTERN = re.compile("[㐀-鿿豈-﫿｡-ﾟ가-힣-]{2}")


def repair(text: str | None, model: dict[str, dict[str, float]] | None = None) -> tuple[bool, str | None, str]:
    """(damaged, restored text or None, the steps taken), however often the text was damaged: a step must make it less odd and give a text that wasn't there before, or there are no more."""
    if not text or text.isascii():
        return False, None, ""
    now, steps, seen = text, [], {text}
    while True:
        tried = [(d, f"utf-8 as {c}") for c in SINGLE if (d := _from_single(c, now)) is not None]
        if (d := _from_legacy(now)) is not None:
            tried.append((d, "legacy as western"))
        if (d := _from_cyrillic(now)) is not None:
            tried.append((d, "cyrillic as another"))
        if _EASTERN.search(now) and (_share(now) < 0.8 or _PRIVATE.search(now) or "\ufffd" in now) and (d := _from_double(now)) is not None:
            tried.append((d, "east asian as another"))
        if not tried and _EASTERN.search(now) and (d := _whole_utf8(now)) is not None:
            if d in seen:
                break
            now, steps = d, [*steps, "utf-8 as east asian"]
            seen.add(now)
            continue
        if not tried:
            if (d := _from_western(now, model or {})) is not None:
                now, steps = d, [*steps, "western as another"]
            break
        # UTF-8 that accounts for nearly every unusual character outweighs what the runs would be in a legacy encoding.
        whole = [x for x in tried if x[1].startswith("utf-8") and _covered(x[1].split(" as ")[1], now) >= 0.9]
        best = min(whole or tried, key=lambda x: _oddness(x[0]))
        if best[0] in seen or not _less_odd(now, best[0]):
            break
        now, steps = best[0], [*steps, best[1]]
        seen.add(now)
    lost = bool(_LOST.search(now))
    return bool(steps) or lost or bool(_LOST.search(text)), None if lost or not steps else now, ", ".join(steps)


def _less_odd(before: str, after: str) -> bool:
    """Whether what changed is less odd by a fifth; characters that both texts have don't count, so that legitimate accents elsewhere hide nothing."""
    a, b = Counter(before), Counter(after)
    return _oddness("".join((b - a).elements())) <= 0.8 * _oddness("".join((a - b).elements()))


def _oddness(text: str) -> float:
    good = frequent_hanzi()
    cost = 0.0
    for c in text:
        k = _kind(c)
        cost += {"x": 3, "?": 2, "g": 1, "l": 0.6, "c": 0.05, "p": 0.2}.get(k, 0) if k != "w" else (0 if c in good else 0.4)
    return cost


def letters_of(samples: DataFrame, lang: str = "lang", text: str = "text") -> dict[str, dict[str, float]]:
    """The letter statistics of a small table of labelled texts."""
    rows = samples.select(lang, text).where(f"{lang} is not null and {text} is not null").limit(MAX_SAMPLES + 1).collect()
    if len(rows) > MAX_SAMPLES:
        raise ValueError(f"more than {MAX_SAMPLES} labelled samples")
    return letter_model([tuple(r) for r in rows])


def find_damaged(df: DataFrame, columns: list[str], key: str = "id", letters: dict[str, dict[str, float]] | None = None) -> DataFrame:
    """`key`, `field_name`, `raw_text`, `restored_text`, `steps`: one row for each damaged value of the columns.

    `letters` (of `letters_of`) tells English names with a damaged apostrophe from words of other languages; without it they are left alone.

    Texts of ASCII alone are dropped in the JVM; the rest is worked on where it is read, without a shuffle of its own.
    """
    from ..session import balanced

    kind = df.schema[key].dataType.simpleString()
    fields = F.array(*[F.struct(F.lit(c).alias("field_name"), F.col(f"`{c}`").alias("raw_text")) for c in columns])
    long = balanced(df.select(F.col(key).alias("k"), F.inline(fields)).where(F.col("raw_text").rlike(r"[^\x00-\x7f]")))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = [(k, f, t, *r[1:]) for k, f, t in zip(b["k"], b["field_name"], b["raw_text"]) if (r := repair(t, letters))[0]]
            out = pd.DataFrame(rows, columns=["k", "field_name", "raw_text", "restored_text", "steps"])
            yield out.astype({"k": b["k"].dtype})

    return long.mapInPandas(run, f"k {kind}, field_name string, raw_text string, restored_text string, steps string").withColumnRenamed("k", key)
