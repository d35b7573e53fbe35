"""Statistics of each document's text, and rules that tell prose from lists, tables and junk.

One scan without a shuffle: each text is counted once, by characters, by lines and by words, in batches of arrays; the shares and the rules are JVM expressions over the counts.
The word lists are small fixed tables, whose size is checked.

Defined results: NULL, empty and blank texts have zero counts, NULL shares and the kind NULL; texts of any length are read whole; repeated
rows give repeated rows. A kind is one of prose, list, table, junk.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Most words or character pairs that may be sent to the tasks.
MAX_LITERALS = 50_000

#: Repetition is measured within windows of so many neighbouring grams, because prose repeats more of its short grams the longer it is; grams of so
#: many words tell loops of longer blocks, because prose hardly ever repeats one.
WINDOW_GRAMS, GRAM, LONG_GRAM = 5000, 3, 13
#: Characters that are worked on together: bounds a task's memory; a longer text is worked on alone, and whole.
CHARACTERS = 1 << 21

_WORD = re.compile("[\u3040-\u30ff\u3400-\u9fff]|[^\\W_\u3040-\u30ff\u3400-\u9fff]+")
_CJK = "[\u3040-\u30ff\u3400-\u9fff]"
_HAS_CJK = re.compile(_CJK)
_S = "[ \\t\\n\\x0b\\f\\r]"
_ENDS = re.compile(rf"[.!?。！？…][\"'”’»」』)）\]]*{_S}*$")
_MARK = re.compile(rf"{_S}*(?:[-*•◦▪‣☐☑☒✓✔–—►●○■□·]{_S}+|[0-9]{{1,3}}[.):、]{_S}*|\[[0-9]+\]{_S}*|\(?[a-zA-Z0-9]{{1,2}}\){_S}+|\[?[0-9]{{1,2}}:[0-9]{{2}}(?::[0-9]{{2}})?\]?{_S}+|[①-⑳]{_S}*)[^ \t\n\x0b\f\r]")
_MACHINE = re.compile(r"\b[\w.-]+=\S+.*\b[\w.-]+=\S+|\{[^{}]*:[^{}]*\}|^\s*(?:at [\w.$]+\(|Traceback|[\w.]+(?:Error|Exception):)|^\s*[{}\[\]]+,?\s*$|^\s*\"[\w-]+\":", re.ASCII)
#: A tag begins with a letter, or a sign before one, whatever its length.
_TAG = re.compile(r"<[/!?]?[A-Za-z][^<>]*>")
_LINES = re.compile("\r\n|[\n\r\u0085\u2028\u2029]")
_PARAGRAPHS = re.compile(rf"\n{_S}*\n")
_UNSEEN = re.compile("[\u200b\ufeff\u00ad]")
_GAP = re.compile(r"\S {2,}(?=\S)", re.ASCII)
_LONG = re.compile(r"\S{50,}", re.ASCII)
_HEX = re.compile(r"(?<!\S)[0-9a-fA-F]{2}(?!\S)", re.ASCII)
_CELL, _ITEM = re.compile(rf"<t[dh](?:{_S}|>)"), re.compile(rf"<li(?:{_S}|>)")

#: What `measure` counts in each text, all of it in one pass.
COUNTS = [
    "n_chars", "n_letters", "n_digits", "n_visible", "n_cjk", "n_lost", "n_terminators", "n_separators", "n_tokens", "n_pairs", "n_known_pairs", "n_cells", "n_items", "n_lines", "n_paragraphs", "n_duplicate_lines", "n_duplicate_paragraphs",
    "line_chars", "duplicate_line_chars", "n_marked", "marked_chars", "n_ended", "n_short", "short_chars", "n_machine", "longest_line", "body_chars", "tab_lines", "bar_lines", "semi_lines", "gap_lines", "comma_lines", "n_semis", "n_gaps", "semi_mode", "comma_mode",
    "n_long_word_chars", "n_hex", "n_words", "word_chars", "n_distinct_words", "top_word", "n_common", "n_alphabetic", "n_single", "n_grams", "n_distinct_grams", "window_duplicates", "window_grams", "n_long_duplicates", "top_gram_chars",
]


def _literals(df: DataFrame, column: str) -> list[str]:
    rows = df.select(column).where(f"{column} is not null").distinct().limit(MAX_LITERALS + 1).collect()
    if len(rows) > MAX_LITERALS:
        raise ValueError(f"more than {MAX_LITERALS} literals for {column}")
    return sorted(r[0] for r in rows)


def common_words(words: DataFrame) -> list[str]:
    """The words of `common_words` that count: single letters of an alphabet say nothing about a language."""
    return [w for w in _literals(words, "word") if len(w) > 1]


def sample_pairs(samples: DataFrame) -> list[str]:
    """Pairs of neighbouring characters in the correctly labelled samples of scripts that are written without blanks."""
    runs = F.regexp_extract_all(F.col("text"), F.lit(f"({_CJK}{{2,}})"), 1)
    each = samples.select(F.explode(runs).alias("r"))
    pairs = each.select(F.explode(F.transform(F.sequence(F.lit(1), F.length("r") - 1), lambda i: F.substring(F.col("r"), i, F.lit(2)))).alias("pair"))
    return _literals(pairs, "pair")


@lru_cache(1)
def _classes() -> np.ndarray:
    """For each code point a set of bits: letter or mark 1, decimal digit 2, visible 4, kana or Han 8, lost 16, blank as patterns see it 32."""
    out = np.zeros(0x110000, dtype=np.uint8)
    for c in range(0x110000):
        k = unicodedata.category(chr(c))
        out[c] = (k[0] in "LM") | (k == "Nd") << 1 | (k[0] not in "ZC") << 2
    out[[*range(0x3040, 0x3100), *range(0x3400, 0xA000)]] |= 8
    out[[0xFFFD, 0x25A1, 0xA4, *range(0, 9), *range(0x0E, 0x20), *range(0x80, 0xA0)]] |= 16
    out[[0x20, *range(0x09, 0x0E)]] |= 32
    out[0x09:0x0E] &= 0xFF ^ 4
    return out


_TERMINATORS = np.array(sorted(map(ord, ".!?。！？")), dtype=np.uint32)
_AFTER = np.array(sorted({*map(ord, "\"'”’»」』)）")}), dtype=np.uint32)
_COMMAS, _OWN_COMMAS = np.array(sorted(map(ord, ",;")), dtype=np.uint32), np.array(sorted(map(ord, "、；،，")), dtype=np.uint32)


def _sums(values: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    return np.bincount(owner, weights=values, minlength=n).astype(np.int64)


def _mix(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def _mode(values: list[int]) -> int:
    return max(map(values.count, set(values)), default=0) if len(values) < 50 else int(np.bincount(values).max())


def _by_characters(texts: list[str], known_pairs: np.ndarray, out: dict[str, np.ndarray]) -> None:
    n = len(texts)
    sizes = np.array(list(map(len, texts)), dtype=np.int64)
    code = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), dtype="<u4")
    owner = np.repeat(np.arange(n), sizes)
    bits = _classes()[code]
    for name, bit in (("n_letters", 1), ("n_digits", 2), ("n_visible", 4), ("n_cjk", 8), ("n_lost", 16)):
        out[name] = _sums((bits & bit) > 0, owner, n)
    # What follows each character; a text's last one is followed by an end.
    ends = np.zeros(len(code), dtype=bool)
    ends[(np.cumsum(sizes) - 1)[sizes > 0]] = True
    after, after_bits = np.append(code[1:], 0).astype(np.uint32), np.append(bits[1:], 0).astype(np.uint8)
    blank = (after_bits & 32) > 0
    out["n_terminators"] = _sums(np.isin(code, _TERMINATORS) & (ends | blank | np.isin(after, _AFTER) | ((after >= 0x3040) & (after < 0xA000))), owner, n)
    out["n_separators"] = _sums((np.isin(code, _COMMAS) & blank & ~ends) | np.isin(code, _OWN_COMMAS), owner, n)
    here = (bits & 32) == 0
    out["n_tokens"] = _sums(here & (ends | blank), owner, n)
    pair = ((bits & 8) > 0) & ((after_bits & 8) > 0) & ~ends
    keys = (code[pair].astype(np.uint64) << np.uint64(32)) | after[pair]
    out["n_known_pairs"] = _sums(np.isin(keys, known_pairs), owner[pair], n)
    out["n_pairs"] = np.maximum(out["n_cjk"] - 1, 0)


def _by_lines(text: str) -> tuple:
    lines = [y for x in _LINES.split(text) if (y := _UNSEEN.sub("", x).rstrip(" ")).strip(" ")]
    paragraphs = [y for x in _PARAGRAPHS.split(text) if (y := x.strip(" "))]
    n_marked = marked = n_ended = n_short = short = n_machine = 0
    for x in lines:
        ended = _ENDS.search(x) is not None
        n_ended += ended
        if _MARK.match(x):
            n_marked += 1
            marked += len(x)
        if not ended and len(x) <= 75 and (len(x) <= 36 or not _HAS_CJK.search(x)):
            n_short += 1
            short += len(x)
        if _MACHINE.search(x):
            n_machine += 1
    body = [len(x) for x in lines[: max(1, len(lines) - 1)]]
    counts = lambda sign, make: [make(x) for x in lines] if sign in text else [0] * len(lines)
    tabs, bars, semis = (counts(c, lambda x, c=c: x.count(c)) for c in "\t|;")
    gaps, commas = counts("  ", lambda x: len(_GAP.findall(x))), counts(",", lambda x: x.count(",") - x.count(", "))
    seen: set[str] = set()
    again = sum(len(x) for x in lines if x in seen or seen.add(x))
    return (
        len(lines), len(paragraphs), len(lines) - len(set(lines)), len(paragraphs) - len(set(paragraphs)), sum(map(len, lines)), again, n_marked, marked, n_ended, n_short, short, n_machine, max(body, default=0), sum(body),
        sum(c >= 1 for c in tabs), sum(c >= 2 for c in bars), sum(c >= 1 for c in semis), sum(c >= 1 for c in gaps), sum(c >= 2 for c in commas), sum(semis), sum(gaps), _mode(semis), _mode(commas),
        sum(len(w) for w in _LONG.findall(text) if not _HAS_CJK.search(w)), len(_HEX.findall(text)),
    )


_LINE_COUNTS = COUNTS[COUNTS.index("n_lines") : COUNTS.index("n_words")]


def _grams(ids: np.ndarray, owner: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(start, key) of the grams of so many words; a gram doesn't go beyond its text, and keys of two texts differ."""
    last = max(0, len(ids) - length + 1)
    start = np.flatnonzero(owner[:last] == owner[length - 1 :]) if last else np.empty(0, dtype=np.int64)
    key = _mix(owner[start].astype(np.uint64))
    with np.errstate(over="ignore"):
        for i in range(length):
            key = _mix(key + ids[start + i].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return start, key


def _by_words(texts: list[str], common: frozenset[str], out: dict[str, np.ndarray]) -> None:
    n = len(texts)
    each = [_WORD.findall(t.lower()) for t in texts]
    sizes = np.array(list(map(len, each)), dtype=np.int64)
    owner = np.repeat(np.arange(n), sizes)
    ids, words = pd.factorize(np.array([w for x in each for w in x], dtype=object))
    del each
    length = np.array([len(w) for w in words], dtype=np.int64)[ids] if len(words) else np.empty(0, dtype=np.int64)
    out["n_words"], out["word_chars"] = sizes, _sums(length, owner, n)
    cjk = [_HAS_CJK.match(w) is not None for w in words]
    kinds = {"n_common": [w in common for w in words], "n_alphabetic": [not c and len(w) > 1 and w.isalpha() for w, c in zip(words, cjk)], "n_single": [not c and len(w) == 1 and w.isalpha() for w, c in zip(words, cjk)]}
    for name, flags in kinds.items():
        out[name] = _sums(np.array(flags, dtype=bool)[ids], owner, n) if len(words) else np.zeros(n, dtype=np.int64)

    def most(keys: np.ndarray, of: np.ndarray) -> np.ndarray:
        best = np.zeros(n, dtype=np.int64)
        np.maximum.at(best, of, keys)
        return best

    key, count = np.unique((owner.astype(np.int64) << 32) | ids, return_counts=True)
    out["n_distinct_words"], out["top_word"] = np.bincount(key >> 32, minlength=n), most(count, key >> 32)
    start, key = _grams(ids, owner, GRAM)
    of = owner[start]
    out["n_grams"] = np.bincount(of, minlength=n)
    _, first, same, count = np.unique(key, return_index=True, return_inverse=True, return_counts=True)
    out["n_distinct_grams"] = np.bincount(of[first], minlength=n)
    # The most frequent gram, of those the longest, then the first one; the words in any of its occurrences count once.
    chars = sum(length[start[first] + i] for i in range(GRAM)) if len(first) else np.empty(0, dtype=np.int64)
    order = np.lexsort((-first, chars, count, of[first]))
    top = order[np.flatnonzero(np.diff(of[first][order], append=n))] if len(order) else order
    is_top = np.zeros(len(first), dtype=bool)
    is_top[top] = True
    hit = start[is_top[same]]
    covered = np.zeros(len(ids), dtype=bool)
    for i in range(GRAM):
        covered[hit + i] = True
    out["top_gram_chars"] = _sums(length * covered, owner, n)
    # Windows of one size over the whole text, the last one ending with it.
    size = np.minimum(out["n_grams"], WINDOW_GRAMS)
    out["window_grams"], out["window_duplicates"] = size.copy(), out["n_grams"] - out["n_distinct_grams"]
    begin = np.cumsum(out["n_grams"]) - out["n_grams"]
    for d in np.flatnonzero(out["n_grams"] > WINDOW_GRAMS):
        last = int(out["n_grams"][d]) - WINDOW_GRAMS
        at = sorted({*range(0, last + 1, WINDOW_GRAMS), last})
        own = key[begin[d] : begin[d] + out["n_grams"][d]]
        out["window_grams"][d] = WINDOW_GRAMS * len(at)
        out["window_duplicates"][d] = sum(WINDOW_GRAMS - len(np.unique(own[i : i + WINDOW_GRAMS])) for i in at)
    start, key = _grams(ids, owner, LONG_GRAM)
    _, first = np.unique(key, return_index=True)
    out["n_long_duplicates"] = np.bincount(owner[start], minlength=n) - np.bincount(owner[start[first]], minlength=n)


def measure(texts: list[str | None], common: frozenset[str], pairs: np.ndarray) -> pd.DataFrame:
    """The counts of each text, by its characters, its lines and its words."""
    raw = [t or "" for t in texts]
    out: dict[str, np.ndarray] = {"n_chars": np.array(list(map(len, raw)), dtype=np.int64)}
    marked = ["<" in t for t in raw]
    low = [t.lower() if m else "" for t, m in zip(raw, marked)]
    out["n_cells"], out["n_items"] = (np.array([len(p.findall(t)) if t else 0 for t in low], dtype=np.int64) for p in (_CELL, _ITEM))
    plain = [_TAG.sub(" ", t) if m else t for t, m in zip(raw, marked)]
    _by_characters(plain, pairs, out)
    lines = np.array([_by_lines(t) for t in plain], dtype=np.int64).reshape(len(plain), len(_LINE_COUNTS))
    out |= {name: lines[:, i] for i, name in enumerate(_LINE_COUNTS)}
    _by_words(plain, common, out)
    return pd.DataFrame({c: out[c].astype(np.int64) for c in COUNTS})


def _batches(texts: list[str | None]) -> Iterator[slice]:
    """Neighbouring texts of so many characters together."""
    at, size = 0, 0
    for i, t in enumerate(texts):
        if i > at and size + len(t or "") > CHARACTERS:
            yield slice(at, i)
            at, size = i, 0
        size += len(t or "")
    if at < len(texts):
        yield slice(at, len(texts))


def _share(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part.cast("double") / whole)


def shares(df: DataFrame) -> DataFrame:
    """`df` (with the counts) and the shares that are made of them."""
    c = F.col
    parts = {
        "mean_word_length": ("word_chars", "n_words"), "digit_ratio": ("n_digits", "n_visible"), "letter_ratio": ("n_letters", "n_visible"), "ended_line_share": ("n_ended", "n_lines"), "marked_line_share": ("n_marked", "n_lines"),
        "marked_char_share": ("marked_chars", "line_chars"), "short_line_share": ("n_short", "n_lines"), "machine_line_share": ("n_machine", "n_lines"), "common_word_share": ("n_common", "n_alphabetic"), "known_pair_share": ("n_known_pairs", "n_pairs"),
        "duplicate_line_share": ("n_duplicate_lines", "n_lines"), "duplicate_line_char_share": ("duplicate_line_chars", "line_chars"), "duplicate_paragraph_share": ("n_duplicate_paragraphs", "n_paragraphs"), "top_gram_char_share": ("top_gram_chars", "word_chars"),
        "window_gram_share": ("window_duplicates", "window_grams"),
    }
    tables = F.greatest(
        _share(c("tab_lines"), c("n_lines")), _share(c("bar_lines"), c("n_lines")),
        F.when((c("n_semis") >= 1.5 * c("n_lines")) & (c("semi_mode") >= 0.6 * c("n_lines")), _share(c("semi_lines"), c("n_lines"))),
        F.when((c("n_gaps") >= 1.3 * c("n_lines")) & (c("n_visible") <= 22 * (c("n_gaps") + c("n_lines"))), _share(c("gap_lines"), c("n_lines"))),
        F.when(c("comma_mode") >= 0.6 * c("n_lines"), _share(c("comma_lines"), c("n_lines"))),
    )
    return df.select(
        "*", *[_share(c(a), c(b)).alias(n) for n, (a, b) in parts.items()], _share(c("n_visible") - c("n_letters") - c("n_digits"), c("n_visible")).alias("symbol_ratio"), _share(c("n_grams") - c("n_distinct_grams"), c("n_grams")).alias("duplicate_gram_share"),
        _share(_share(c("body_chars"), F.greatest(c("n_lines") - 1, F.lit(1))), c("longest_line")).alias("line_evenness"), tables.alias("cell_line_share"),
    )


def kind() -> Column:
    """The kind of a text by its statistics; the first rule that holds."""
    c = F.col
    cjk = c("n_cjk") * 2 > c("n_letters")
    table = (c("n_cells") >= 4) | ((c("n_lines") >= 3) & (F.coalesce(c("cell_line_share"), F.lit(0)) >= 0.7) & (c("n_machine") * 2 < c("n_lines")) & (c("n_lost") * 10 < c("n_visible")))
    machine = (
        (c("machine_line_share") >= 0.5)
        | (c("n_lost") * 12 > c("n_visible"))
        | (c("n_long_word_chars") * 2 > c("n_chars"))
        | ((c("n_tokens") >= 16) & (c("n_hex") * 2 > c("n_tokens")))
    )
    few = c("n_distinct_words") * 4 < c("n_words")
    grams = (c("top_gram_char_share") >= 0.35) | (c("top_word") * 2.2 > c("n_words")) | (c("window_gram_share") > 0.8) | (c("n_long_duplicates") > 0.8 * (c("n_words") - 2))
    # Boilerplate: most of the text is lines or paragraphs that were there before.
    blocks = ((c("n_lines") >= 6) & (c("duplicate_line_share") >= 0.6) & (c("duplicate_line_char_share") >= 0.6)) | ((c("n_paragraphs") >= 4) & (c("duplicate_paragraph_share") >= 0.6) & (c("duplicate_line_char_share") >= 0.5))
    repeated = (c("n_words") >= 12) & ((few & grams) | blocks)
    marked = (c("n_items") >= 3) | ((c("n_marked") >= 3) & (c("marked_char_share") >= 0.45) & (c("marked_line_share") >= 0.5))
    plain_lines = (c("n_lines") >= 4) & (c("short_line_share") >= 0.7) & (c("short_chars") * 2 > c("line_chars")) & (c("line_evenness") < 0.78) & (c("n_terminators") <= 1 + 0.25 * c("n_lines"))
    in_line = (c("n_separators") >= 7) & (c("n_terminators") * 8 < c("n_separators")) & (c("n_visible") < F.when(cjk, 16).otherwise(45) * (c("n_separators") + 1)) & (c("n_lines") * 4 <= c("n_separators"))
    symbols = c("letter_ratio") < 0.45
    scrambled = (
        F.when(cjk, (c("n_cjk") >= 20) & (c("known_pair_share") < 0.2))
        .otherwise((c("n_alphabetic") + c("n_single") >= 12) & ((c("n_common") < 0.055 * (c("n_alphabetic") + c("n_single")))))
    )
    return (
        F.when(c("n_visible") == 0, None)
        .when(table, "table")
        .when(machine | repeated, "junk")
        .when(marked, "list")
        .when(symbols, "junk")
        .when(in_line | plain_lines, F.when(scrambled & ~in_line & (c("n_short") < c("n_lines") * 0.5), "junk").otherwise("list"))
        .when(scrambled, "junk")
        .otherwise("prose")
    )


STATISTICS = [
    "n_chars", "n_words", "n_lines", "mean_word_length", "symbol_ratio", "digit_ratio", "letter_ratio", "ended_line_share", "marked_line_share", "short_line_share",
    "common_word_share", "known_pair_share", "duplicate_line_share", "duplicate_line_char_share", "duplicate_paragraph_share", "duplicate_gram_share", "top_gram_char_share", "cell_line_share", "machine_line_share",
]


def describe(df: DataFrame, common: list[str], pairs: list[str], key: str = "doc_id", text: str = "text") -> DataFrame:
    """`key`, the statistics and `text_kind`, one row per row.

    Texts are counted where they are read, in Arrow batches and mostly over arrays of all their characters and words at once; shares and rules are JVM expressions.
    """
    from ..session import balanced

    spark = df.sparkSession
    known = spark.sparkContext.broadcast((frozenset(common), np.array(sorted(ord(p[0]) << 32 | ord(p[1]) for p in pairs), dtype=np.uint64)))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            texts = b["_text"].tolist()
            for part in _batches(texts):
                yield measure(texts[part], *known.value).assign(_key=b["_key"].to_numpy()[part])[["_key", *COUNTS]]

    kind_of_key = df.schema[key].dataType.simpleString()
    narrow = balanced(df.select(F.col(key).alias("_key"), F.col(text).alias("_text")))
    counted = narrow.mapInPandas(run, f"_key {kind_of_key}, " + ", ".join(f"{c} long" for c in COUNTS))
    return shares(counted).select(F.col("_key").alias(key), *STATISTICS, kind().alias("text_kind"))
