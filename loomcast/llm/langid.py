"""The language of texts and of the sentences in them, with a confidence.

Each language has probabilities of the pieces of a fixed public vocabulary, learned from the labelled samples by expectation maximisation over
all segmentations. A text's likelihood is the sum over all its segmentations into pieces, by a forward algorithm; as pieces don't cross blanks,
it is a product over words (and over single kana and Han characters), which are remembered while a task runs. A sentence's language is the one
of the greatest posterior (equal priors); its confidence is that posterior.

Defined results: NULL, empty and blank texts, and those without a whole sentence (too few words, or too uncertain) have no language. Labels that
write the right language otherwise are right; labels that name no language are missing. The samples are a fixed table whose size is checked.
"""

from __future__ import annotations

import math
import os
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

VOCABULARY = os.environ.get("LOOMCAST_TOKENIZERS", "/opt/tokenizers") + "/piece_bpe_32k.model"
#: Most labelled samples that are read for the fit.
MAX_SAMPLES = 20_000
ROUNDS = 4
SMOOTHING = 0.02
UNKNOWN = math.log(1e-7)
LEAST_CONFIDENCE = 0.95
LEAST_WORDS = 4
LEAST_CHARACTERS = 7
CACHE = 300_000
#: Words of foreign names at the edge of a sentence must not make a language: a second language needs this lead in nats over the first.
LEAD = 6.0

# How the eight languages are written in labels (two and three letters, English name, own name).
NAMES = {
    "en": ("en", "eng", "english"),
    "zh": ("zh", "zho", "chi", "cmn", "chinese", "中文", "简体中文", "繁體中文", "汉语", "漢語", "普通话"),
    "de": ("de", "deu", "ger", "german", "deutsch"),
    "es": ("es", "spa", "spanish", "español", "espanol", "castellano"),
    "fr": ("fr", "fra", "fre", "french", "français", "francais"),
    "ja": ("ja", "jpn", "japanese", "日本語"),
    "pt": ("pt", "por", "portuguese", "português", "portugues"),
    "ru": ("ru", "rus", "russian", "русский"),
}
_UNITS = re.compile("[぀-ヿ㐀-鿿]|[^\\W\\d_぀-ヿ㐀-鿿]+")
_CJK = re.compile("[぀-ヿ㐀-鿿]")
_SENTENCE = re.compile(r"[^.!?。！？…\n\r]+(?:(?<=[A-Za-z0-9])\.(?=[a-zº0-9])[^.!?。！？…\n\r]+)*")


def label_language(label: Column) -> Column:
    """The two letters of a label, NULL if it names none of the languages; region, script and case don't matter."""
    word = F.regexp_extract(F.lower(F.trim(label)), r"^([\p{L}]+)", 1)
    out = F.lit(None).cast("string")
    for code, names in NAMES.items():
        out = F.when(word.isin(*names), code).otherwise(out)
    return out


@dataclass
class Model:
    languages: list[str]
    pieces: dict[str, np.ndarray]  # probabilities by language
    longest: int
    unknown: np.ndarray
    cache: dict[str, np.ndarray] = field(default_factory=dict)

    def word(self, w: str) -> np.ndarray:
        """The log likelihood of a word in each language, over all segmentations."""
        if (hit := self.cache.get(w)) is not None:
            return hit
        out = self._forward(w)
        if len(self.cache) < CACHE:
            self.cache[w] = out
        return out

    def _forward(self, w: str) -> np.ndarray:
        """Sums over all segmentations of the whole word; scaled now and then, which keeps probabilities within the range of doubles."""
        alpha: list = [1.0]
        scaled = 0.0
        get, longest = self.pieces.get, self.longest
        for end in range(1, len(w) + 1):
            now = None
            for start in range(max(0, end - longest), end):
                if (p := get(w[start:end])) is not None:
                    term = alpha[start] * p
                    now = term if now is None else now + term
            if get(w[end - 1]) is None:  # a character outside the vocabulary costs every language the same
                term = alpha[end - 1] * self.unknown
                now = term if now is None else now + term
            alpha.append(now)
            if end % 24 == 0:
                # Only the last `longest` sums are read again; each language is scaled by itself.
                top = np.maximum(alpha[-1], 1e-300)
                for i in range(max(0, len(alpha) - longest), len(alpha)):
                    alpha[i] = alpha[i] / top
                scaled = scaled + np.log(top)
        return np.log(alpha[-1]) + scaled


def units(sentence: str) -> list[str]:
    """What is scored: words with the vocabulary's mark of a word's start, and single kana and Han characters."""
    return [u if _CJK.match(u) else "▁" + u for u in _UNITS.findall(sentence)]


def fit(samples: list[tuple[str, str]], path: str = VOCABULARY, rounds: int = ROUNDS) -> Model:
    """Per-language piece probabilities by expectation maximisation on the samples (language, text)."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    vocabulary = {p for i in range(sp.get_piece_size()) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i)) for p in [sp.id_to_piece(i)]}
    languages = sorted({lang for lang, _ in samples})
    longest = max(map(len, vocabulary))
    counts: dict[str, dict[str, int]] = {}
    for lang, text in samples:
        own = counts.setdefault(lang, {})
        for u in units(text.lower()):
            own[u] = own.get(u, 0) + 1
    probabilities: dict[str, dict[str, float]] = {}
    flat = math.log(1 / len(vocabulary))
    for lang in languages:
        now: dict[str, float] = {}
        for _ in range(rounds):
            expected: dict[str, float] = {}
            for w, n in counts[lang].items():
                spans = [(a, b, now.get(w[a:b], flat)) for b in range(1, len(w) + 1) for a in range(max(0, b - longest), b) if w[a:b] in vocabulary]
                known = {(a, b) for a, b, _ in spans}
                spans += [(a, a + 1, UNKNOWN) for a in range(len(w)) if (a, a + 1) not in known]
                fore, back = [0.0] + [-math.inf] * len(w), [-math.inf] * len(w) + [0.0]
                for a, b, p in sorted(spans, key=lambda x: x[1]):
                    fore[b] = float(np.logaddexp(fore[b], fore[a] + p))
                for a, b, p in sorted(spans, key=lambda x: -x[0]):
                    back[a] = float(np.logaddexp(back[a], back[b] + p))
                for a, b, p in spans:
                    if (a, b) in known:
                        expected[w[a:b]] = expected.get(w[a:b], 0.0) + n * math.exp(fore[a] + p + back[b] - fore[-1])
            total = sum(expected.values())
            now = {p: math.log(c / total) for p, c in expected.items() if c > 1e-6 * total}
        probabilities[lang] = now
    seen = {p for own in probabilities.values() for p in own}
    floor = SMOOTHING / len(vocabulary)
    pieces = {p: np.array([(1 - SMOOTHING) * math.exp(probabilities[lang].get(p, -math.inf)) + floor for lang in languages]) for p in seen}
    rest = np.full(len(languages), floor)
    return Model(languages, {p: pieces.get(p, rest) for p in vocabulary}, longest, np.full(len(languages), math.exp(UNKNOWN)))


def judge(model: Model, sentence: str) -> tuple[str | None, float]:
    """(language, confidence) of one sentence; no language if it is too short or too uncertain."""
    us = units(sentence.lower())
    characters = sum(not u.startswith("▁") for u in us)
    if len(us) - characters < LEAST_WORDS and characters < LEAST_CHARACTERS:
        return None, 0.0
    score = np.sum([model.word(u) for u in us], axis=0)
    best = int(score.argmax())
    confidence = float(1 / np.exp(score - score[best]).sum())
    lead = score[best] - np.partition(score, -2)[-2]
    return (model.languages[best] if confidence >= LEAST_CONFIDENCE and lead >= LEAD else None), confidence


def segments_of(model: Model, text: str | None) -> list[tuple[int, int, str, float, int]]:
    """(start, end, language, confidence, sentences) of each stretch of neighbouring sentences in one language; confidence is the least of its sentences.

    Places count characters. A sentence without a language of its own (too short, too uncertain) goes with the one before it, or the first one after.
    """
    out: list[list] = []
    first = None
    for m in _SENTENCE.finditer(text or ""):
        if not m[0].strip():
            continue
        lang, confidence = judge(model, m[0])
        if lang is None:
            if out:
                out[-1][1] = m.end()
            elif first is None:
                first = m.start()
        elif out and out[-1][2] == lang:
            out[-1][1], out[-1][3], out[-1][4] = m.end(), min(out[-1][3], confidence), out[-1][4] + 1
        else:
            out.append([m.start() if out or first is None else first, m.end(), lang, confidence, 1])
    return [tuple(x) for x in out]


def languages_of(model: Model, text: str | None) -> list[tuple[str, float, int]]:
    """(language, confidence, sentences) for each language with a whole sentence in the text."""
    found: dict[str, list[tuple[float, int]]] = {}
    for _, _, lang, confidence, n in segments_of(model, text):
        found.setdefault(lang, []).append((confidence, n))
    return [(lang, min(c for c, _ in x), sum(n for _, n in x)) for lang, x in found.items()]


def fitted(samples: DataFrame, lang: str = "lang", text: str = "text", path: str = VOCABULARY) -> Model:
    rows = samples.select(lang, text).where(f"{lang} is not null and {text} is not null").orderBy(lang, text).limit(MAX_SAMPLES + 1).collect()
    if len(rows) > MAX_SAMPLES:
        raise ValueError(f"more than {MAX_SAMPLES} labelled samples")
    return fit([(r[0], r[1]) for r in rows], path)


def segments(df: DataFrame, model: Model, key: list[str], text: str, label: str) -> DataFrame:
    """`key`..., `label_code`, `segment`, `seg_start`, `seg_end`, `lang_code`, `confidence`, `n_sentences`, `n_languages`: one row for each segment of each text.

    Texts are judged where they are read; the model (some megabytes, bounded by the vocabulary) travels with the task.
    """
    from ..session import balanced

    shared = df.sparkSession.sparkContext.broadcast(model)
    narrow = balanced(df.select(*key, F.col(text).alias("_t"), label_language(F.col(label)).alias("label_code")).where(F.length(F.trim("_t")) > 0))
    own = ", ".join(f"{k} {narrow.schema[k].dataType.simpleString()}" for k in key)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m = shared.value
        for b in batches:
            rows = []
            for r in b.itertuples(index=False):
                found = segments_of(m, r[len(key)])
                many = len({x[2] for x in found})
                rows += [(*r[: len(key)], r[len(key) + 1], i, *x, many) for i, x in enumerate(found)]
            yield pd.DataFrame(rows, columns=[*key, "label_code", "segment", "seg_start", "seg_end", "lang_code", "confidence", "n_sentences", "n_languages"])

    kinds = "label_code string, segment int, seg_start int, seg_end int, lang_code string, confidence double, n_sentences int, n_languages int"
    return narrow.select(*key, "_t", "label_code").mapInPandas(run, f"{own}, {kinds}")


def mislabelled(found: DataFrame) -> DataFrame:
    """Of `segments`: those of texts with no or a wrong label, or with several languages."""
    return found.where("label_code is null or n_languages > 1 or label_code <> lang_code")
