"""Evaluation texts inside training documents, by an FM-index of each shard of the corpus.

A shard is a bounded stretch of one partition. Its words become numbers (words that no test phrase has are one number, which never matches
and also parts the documents), its suffixes are sorted as far as a phrase is long, and the last column of the sorted rotations goes into a
wavelet matrix. All test phrases (windows of `n` consecutive words of an item) are then searched backward at once: each step narrows every
phrase's range by two rank queries. Found ranges are located by walking to sampled suffix positions, and the positions are merged into spans.

Defined results: NULL and empty documents hold nothing; an item with fewer words than its window can't be found; items that share a text are
all reported; markup between `<` and the next `>` counts as a blank; a `<` without `>` is text. A document longer than a shard is a shard of
its own and read whole; nothing is cut.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

N_WORDS = 12
N_CHARACTERS = 30
CHARACTER_LANGUAGES = ("zh", "ja")
#: Words of a shard: bounds a task's memory (some 100 bytes a word), not the corpus.
SHARD_WORDS = 1_000_000
SAMPLE_RATE = 8
#: Most evaluation items, and most of their characters, that a task holds at once; more are searched in blocks, each over all documents.
MAX_ITEMS, MAX_CHARACTERS = 100_000, 64 << 20

_WORD = re.compile("[぀-ヿ㐀-鿿]|[^\\W_぀-ヿ㐀-鿿]+")
_MARKUP = re.compile("<[^>]*>")


def words(text: str) -> list[str]:
    """Runs of letters and digits, lower-cased; each kana or Han character by itself."""
    return _WORD.findall(text.lower())


@dataclass
class Phrases:
    """Windows of the items: `ids[k]` are the word numbers of phrase k (all of one length), `owners[k]` its item ids."""

    vocabulary: dict[str, int]
    by_length: dict[int, tuple[np.ndarray, list[list[int]]]]


def phrases(items: list[tuple[int, str | None, str | None]], n_words: int = N_WORDS, n_characters: int = N_CHARACTERS) -> Phrases:
    vocabulary: dict[str, int] = {}
    found: dict[int, dict[tuple[int, ...], list[int]]] = {}
    for item, lang, text in items:
        if not text:
            continue
        numbers = [vocabulary.setdefault(w, len(vocabulary) + 1) for w in words(text)]
        n = n_characters if lang in CHARACTER_LANGUAGES else n_words
        for i in range(len(numbers) - n + 1):
            owners = found.setdefault(n, {}).setdefault(tuple(numbers[i : i + n]), [])
            if not owners or owners[-1] != item:
                owners.append(item)
    return Phrases(vocabulary, {n: (np.array(list(p), dtype=np.int32), list(p.values())) for n, p in found.items()})


class WaveletMatrix:
    """Rank queries over a sequence of small numbers: one bit vector a level, zeros before ones at the next."""

    def __init__(self, sequence: np.ndarray, top: int):
        self.levels = max(1, int(top).bit_length())
        self.ones, self.zeros = [], []
        now = sequence
        for k in range(self.levels - 1, -1, -1):
            bit = (now >> k) & 1
            self.ones.append(np.concatenate(([0], np.cumsum(bit, dtype=np.int32))).astype(np.int32))
            self.zeros.append(int(len(now) - self.ones[-1][-1]))
            now = np.concatenate((now[bit == 0], now[bit == 1]))

    def rank(self, symbol: np.ndarray, upto: np.ndarray) -> np.ndarray:
        """How often each symbol occurs before each position."""
        low, high = np.zeros_like(upto), upto
        for level, k in enumerate(range(self.levels - 1, -1, -1)):
            ones, zeros = self.ones[level], self.zeros[level]
            one = ((symbol >> k) & 1).astype(bool)
            low1, high1 = ones[low], ones[high]
            low, high = np.where(one, zeros + low1, low - low1), np.where(one, zeros + high1, high - high1)
        return high - low

    def access(self, at: np.ndarray) -> np.ndarray:
        out = np.zeros_like(at)
        for level in range(self.levels):
            ones, zeros = self.ones[level], self.zeros[level]
            one = ones[at + 1] - ones[at]
            out = (out << 1) | one
            at = np.where(one == 1, zeros + ones[at], at - ones[at])
        return out


class FmIndex:
    """An FM-index of a sequence of numbers from 0 to `top`. Inside, all are one higher: 0 is the end of the text, which must occur but once."""

    def __init__(self, sequence: np.ndarray, top: int, rate: int = SAMPLE_RATE):
        top += 1
        text = np.append(sequence.astype(np.int64) + 1, 0)
        n = len(text)
        rank, width = text.copy(), 1
        order = np.argsort(rank, kind="stable")
        # Sorted all the way, in as many rounds as the longest repeat has binary digits.
        while True:
            key = rank * (n + int(rank.max()) + 2) + np.concatenate((rank[width:] + 1, np.zeros(min(width, n), dtype=np.int64)))[:n]
            order = np.argsort(key, kind="stable")
            fresh = np.empty(n, dtype=np.int64)
            fresh[order] = np.concatenate(([0], np.cumsum(key[order][1:] != key[order][:-1])))
            rank, width = fresh, width * 2
            if rank[order[-1]] == n - 1:
                break
        self.n = n
        self.last = text[order - 1]
        self.before = np.concatenate(([0], np.cumsum(np.bincount(text, minlength=top + 1)))).astype(np.int64)
        self.matrix = WaveletMatrix(self.last, top)
        self.sampled = order % rate == 0
        self.sample_rank = np.concatenate(([0], np.cumsum(self.sampled)))
        self.samples = order[self.sampled]

    def search(self, patterns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The suffix ranges of all patterns (rows of one length)."""
        low, high = np.zeros(len(patterns), dtype=np.int64), np.full(len(patterns), self.n, dtype=np.int64)
        alive = np.arange(len(patterns))
        for k in range(patterns.shape[1] - 1, -1, -1):
            s = patterns[alive, k].astype(np.int64) + 1
            low[alive] = self.before[s] + self.matrix.rank(s, low[alive])
            high[alive] = self.before[s] + self.matrix.rank(s, high[alive])
            alive = alive[low[alive] < high[alive]]
            if not len(alive):
                break
        return low, np.maximum(high, low)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """The text positions of suffix rows: walk back to a sampled one."""
        out, steps, at = np.zeros(len(rows), dtype=np.int64), np.zeros(len(rows), dtype=np.int64), rows.copy()
        todo = np.arange(len(rows))
        while len(todo):
            hit = self.sampled[at[todo]]
            done = todo[hit]
            out[done] = self.samples[self.sample_rank[at[done]]] + steps[done]
            todo = todo[~hit]
            if len(todo):
                s = self.matrix.access(at[todo])
                at[todo] = self.before[s] + self.matrix.rank(s, at[todo])
                steps[todo] += 1
        return out


def search_shard(keys: list, texts: list[str | None], what: Phrases) -> list[tuple]:
    """(document, item, spans) of a shard: spans are merged stretches of word positions [first, last)."""
    vocabulary, numbers, starts = what.vocabulary, [], []
    for t in texts:
        starts.append(len(numbers))
        if t:
            numbers += [vocabulary.get(w, 0) for w in words(_MARKUP.sub(" ", t) if "<" in t else t)]
        numbers.append(0)
    if not what.by_length or len(numbers) == len(texts):
        return []
    sequence = np.array(numbers, dtype=np.int64)
    # Stretches of separators carry nothing: keep one, and remember where each kept word stood.
    keep = np.ones(len(sequence), dtype=bool)
    keep[1:] = (sequence[1:] != 0) | (sequence[:-1] != 0)
    places = np.flatnonzero(keep)
    index = FmIndex(sequence[keep], len(vocabulary))
    starts_at = np.array(starts)
    spans: dict[tuple[int, int], list[tuple[int, int]]] = {}
    for n, (patterns, owners) in what.by_length.items():
        low, high = index.search(patterns)
        hit = np.flatnonzero(high > low)
        if not len(hit):
            continue
        rows = np.concatenate([np.arange(low[h], high[h]) for h in hit])
        which = np.repeat(hit, high[hit] - low[hit])
        at = places[index.locate(rows)]
        doc = np.searchsorted(starts_at, at, side="right") - 1
        for p, a, d in zip(which.tolist(), at.tolist(), doc.tolist()):
            for item in owners[p]:
                spans.setdefault((d, item), []).append((a - starts[d], a - starts[d] + n))
    out = []
    for (d, item), found in spans.items():
        merged: list[list[int]] = []
        for a, b in sorted(found):
            if merged and a <= merged[-1][1]:
                merged[-1][1] = max(b, merged[-1][1])
            else:
                merged.append([a, b])
        out.append((keys[d], item, [{"first": a, "last": b - 1} for a, b in merged]))
    return out


def find_leaks(documents: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", n_words: int = N_WORDS, n_characters: int = N_CHARACTERS, shard_words: int = SHARD_WORDS, most_items: int = MAX_ITEMS) -> DataFrame:
    """`key`, `item_id`, `spans` (word positions, merged): the documents that hold a window of an item's words.

    The items are a small test set, counted first: as many as a task may hold travel with it, more go in blocks of whole items, and the results are put
    together. Each partition of documents is indexed and
    searched where it is read; nothing of the corpus is shuffled but the spreading of a small input, or sent to the driver.
    """
    size = items.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.length("item_text")), F.lit(0)).alias("c")).first()
    blocks = max(1, -(-size.n // most_items), -(-size.c // MAX_CHARACTERS))
    out = None
    for i in range(blocks):
        own = items if blocks == 1 else items.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == i)
        found = _find_block(documents, own.select("item_id", "lang", "item_text").collect(), key, text, n_words, n_characters, shard_words)
        out = found if out is None else out.unionByName(found)
    return out


def _find_block(documents: DataFrame, rows: list, key: str, text: str, n_words: int, n_characters: int, shard_words: int) -> DataFrame:
    from ..session import balanced

    shared = documents.sparkSession.sparkContext.broadcast([(r.item_id, r.lang, r.item_text) for r in rows])
    kind = documents.schema[key].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        what = phrases(shared.value, n_words, n_characters)
        keys, texts, size = [], [], 0

        def flush() -> pd.DataFrame:
            return pd.DataFrame(search_shard(keys, texts, what), columns=["k", "item_id", "spans"])

        for b in batches:
            for k, t in zip(b["k"].tolist(), b["t"].tolist()):
                keys.append(k)
                texts.append(t)
                size += len(t) // 3 + 1 if t else 1
                if size >= shard_words:
                    yield flush()
                    keys, texts, size = [], [], 0
        if keys:
            yield flush()

    narrow = balanced(documents.select(F.col(key).alias("k"), F.col(text).alias("t")).where(F.length("t") > 0))
    return narrow.mapInPandas(run, f"k {kind}, item_id long, spans array<struct<first:int,last:int>>").withColumnRenamed("k", key)
