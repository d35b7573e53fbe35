"""Encoding of a corpus with a public byte-level BPE vocabulary, by Spark's higher-order functions.

The texts are split into words, and those at the places that no merge can bridge; each distinct part of the corpus is encoded once: its
bytes become ids, and a fold merges, step by step, the
neighbouring pair of the lowest rank, the ranks of pairs being a literal of the plan (buckets of a few pairs, so that a look-up is short).
Documents are then put together where they are read: the most frequent `HOT` parts go to every task, the rest are joined by their bytes, and only these
and the documents that hold them move. Which parts are frequent decides the way alone, never the ids. Decoding concatenates the binary pieces of a second literal.

Defined results: NULL and empty texts have an empty array; special tokens are ordinary text; rows that repeat a document give a row each. Parts of
more than `LONG_WORD` bytes, for which the fold's square cost would grow, go through an exact heap of the same merges.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import os
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

VOCABULARY = os.environ.get("LOOMCAST_TOKENIZERS", "/opt/tokenizers") + "/byte_bpe_50k.json"
BUCKETS = 8191  # a prime, so that pairs spread whatever their second id
LONG_WORD = 400
NO_MERGE = 1 << 30
_KEYED = 1 << 33  # above every id: keys and ids share the buckets
#: Parts that every task holds, and the most bytes of one: a few megabytes at any size of the corpus.
HOT, HOT_BYTES = 1 << 17, 32
#: Characters that are split together: bounds a task's memory; a longer text is split alone, and whole.
CHARACTERS = 1 << 20
#: Bytes of a part up to which its hash is made over all parts at once.
_WIDE = 64

# White space by Unicode's property, which the vocabulary's pattern means by \s; what may follow an apostrophe as a word of its own.
BLANKS = (*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)
CONTRACTIONS = ("s", "t", "re", "ve", "m", "ll", "d")


def _byte_letters() -> list[str]:
    """The printable letter that the vocabulary file writes for each byte: printable Latin-1 stands for itself, the rest follows from U+0100."""
    own = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or 0xAE <= b <= 0xFF]
    out = {b: chr(b) for b in own}
    for i, b in enumerate(b for b in range(256) if b not in out):
        out[b] = chr(0x100 + i)
    return [out[b] for b in range(256)]


@lru_cache(4)
def vocabulary(path: str = VOCABULARY) -> tuple[list[int], dict[tuple[int, int], int], list[bytes]]:
    """(ids of the single bytes, merged id of each pair, the bytes of each id); a lower merged id is a lower rank."""
    with open(path, encoding="utf-8") as f:
        model = json.load(f)["model"]
    ids, letters = model["vocab"], _byte_letters()
    merges: dict[tuple[int, int], int] = {}
    for m in model["merges"]:
        a, b = m.split(" ") if isinstance(m, str) else m
        merges[ids[a], ids[b]] = ids[a + b]
    if list(merges.values()) != sorted(merges.values()):
        raise ValueError("ids don't follow the ranks of the merges")
    back = {c: b for b, c in enumerate(letters)}
    pieces = [b""] * (max(ids.values()) + 1)
    for piece, i in ids.items():
        if all(c in back for c in piece):
            pieces[i] = bytes(back[c] for c in piece)
    return [ids[c] for c in letters], merges, pieces


@lru_cache(4)
def seams(path: str = VOCABULARY) -> np.ndarray:
    """For each pair of bytes whether no merge can ever bridge them.

    A merge makes a piece of the vocabulary; so if no piece has two bytes side by side, the parts before and after that place are
    encoded independently. This cuts words of scripts without blanks into short parts, of which there are few distinct ones.
    """
    out = np.ones((256, 256), dtype=bool)
    for piece in vocabulary(path)[2]:
        p = np.frombuffer(piece, dtype=np.uint8)
        out[p[:-1], p[1:]] = False
    return out


@lru_cache(1)
def _classes() -> np.ndarray:
    """For each code point: letter 1, number 2, blank 3, other 4."""
    out = np.array([{"L": 1, "N": 2}.get(unicodedata.category(chr(c))[0], 4) for c in range(0x110000)], dtype=np.uint8)
    out[list(BLANKS)] = 3
    return out


def word_starts(code: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Where words start in the characters of texts, whose own starts are `first` (flags).

    Words are runs of letters, of numbers, of blanks, of others. A plain space before another run belongs to that run; of more blanks before one the last is by itself
    (or belongs to it); an apostrophe by itself takes one of the contractions and ends with it.
    """
    n = len(code)
    kind = _classes()[code]
    run = first | (kind != np.append(0, kind[:-1]))
    start = run.copy()
    at = np.flatnonzero(run)
    length = np.diff(np.append(at, n))
    blank = kind[at] == 3
    # Runs of blanks with another run of the same text after them.
    follow = np.append(~first[at[1:]], False) if len(at) else np.empty(0, dtype=bool)
    before = np.flatnonzero(blank & follow)
    last = at[before] + length[before] - 1
    start[last] = True
    own = code[last] == 0x20
    start[last[own] + 1] = False
    # Apostrophes that begin a word: a run of one, and no plain space before it.
    lone = at[(kind[at] == 4) & (length == 1) & (code[at] == 0x27)]
    lone = lone[start[lone]]
    for tail in CONTRACTIONS:
        fits = lone[lone + len(tail) < n]
        for i, c in enumerate(tail, 1):
            fits = fits[(code[fits + i] == ord(c)) & ~first[fits + i]]
        start[fits + 1] = False
        end = fits + len(tail) + 1
        start[end[end < n]] = True
        lone = lone[~np.isin(lone, fits)]
    return start


def split_parts(texts: list[str], path: str = VOCABULARY) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(the bytes of all texts, where parts start in them, the text of each part)."""
    whole = "".join(texts)
    code = np.frombuffer(whole.encode("utf-32-le"), dtype="<u4")
    sizes = np.array(list(map(len, texts)), dtype=np.int64)
    begin = np.cumsum(sizes) - sizes
    first = np.zeros(len(code), dtype=bool)
    first[begin[sizes > 0]] = True
    raw = np.frombuffer(whole.encode("utf-8"), dtype=np.uint8)
    lead = (raw & 0xC0) != 0x80
    cut = np.zeros(len(raw), dtype=bool)
    cut[lead] = word_starts(code, first)
    cut[1:] |= seams(path)[raw[:-1], raw[1:]]
    starts = np.flatnonzero(cut)
    place = np.cumsum(lead) - 1
    owner = np.searchsorted(begin[sizes > 0], place[starts], side="right") - 1
    return raw, starts, np.flatnonzero(sizes > 0)[owner]


def part_hashes(raw: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(64-bit hash, length) of each part."""
    lengths = np.diff(np.append(starts, len(raw)))
    h = lengths.astype(np.uint64)
    active = np.flatnonzero(lengths <= _WIDE)
    with np.errstate(over="ignore"):
        j = 0
        while len(active):
            h[active] = (h[active] ^ (raw[starts[active] + j].astype(np.uint64) + np.uint64(1))) * np.uint64(0x9E3779B97F4A7C15)
            h[active] ^= h[active] >> np.uint64(29)
            j += 1
            active = active[lengths[active] > j]
    for i in np.flatnonzero(lengths > _WIDE):
        h[i] = int.from_bytes(hashlib.blake2b(raw[starts[i] : starts[i] + lengths[i]].tobytes(), digest_size=8).digest(), "little")
    return h, lengths


def _batches(texts: list[str]) -> Iterator[slice]:
    at, size = 0, 0
    for i, t in enumerate(texts):
        if i > at and size + len(t) > CHARACTERS:
            yield slice(at, i)
            at, size = i, 0
        size += len(t)
    if at < len(texts):
        yield slice(at, len(texts))


class _Hot:
    """The frequent parts: a table from hashes to ids. A part is found if hash, length and all its bytes are the same."""

    SLOTS = 20

    def __init__(self, parts: list[bytes], ids: list[np.ndarray]):
        self.bytes = np.frombuffer(b"".join(parts) or b"\0", dtype=np.uint8)
        self.length = np.array(list(map(len, parts)), dtype=np.int64)
        self.start = np.cumsum(self.length) - self.length
        self.ids = np.concatenate(ids).astype(np.uint32) if ids else np.empty(0, dtype=np.uint32)
        self.n_ids = np.array(list(map(len, ids)), dtype=np.int64)
        self.at = np.cumsum(self.n_ids) - self.n_ids
        h = part_hashes(self.bytes, self.start)[0] if parts else np.empty(0, dtype=np.uint64)
        slot = (h >> np.uint64(64 - self.SLOTS)).astype(np.int64)
        # Of parts that share a slot the most frequent, which comes first, has it.
        self.of_slot = np.full(1 << self.SLOTS, -1, dtype=np.int32)
        self.of_slot[slot[::-1]] = np.arange(len(parts), dtype=np.int32)[::-1]
        self.hash = h

    def find(self, raw: np.ndarray, starts: np.ndarray, h: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """The number of each part among the frequent ones, or -1."""
        found = self.of_slot[(h >> np.uint64(64 - self.SLOTS)).astype(np.int64)].astype(np.int64)
        maybe = np.flatnonzero(found >= 0)
        number = found[maybe]
        fine = (self.hash[number] == h[maybe]) & (self.length[number] == lengths[maybe])
        found[maybe[~fine]] = -1
        maybe, number = maybe[fine], number[fine]
        for j in range(HOT_BYTES):  # byte by byte over all parts that are long enough
            more = self.length[number] > j
            maybe, number = maybe[more], number[more]
            if not len(maybe):
                break
            other = self.bytes[self.start[number] + j] != raw[starts[maybe] + j]
            if other.any():
                found[maybe[other]] = -1
        return found


def _expand(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    total = int(lengths.sum())
    return np.arange(total) - np.repeat(np.cumsum(lengths) - lengths, lengths) + np.repeat(starts, lengths) if total else np.empty(0, dtype=np.int64)


def _literal(value: object, kind: str) -> Column:
    """A constant of the plan: folded once by the optimizer."""
    return F.from_json(F.lit(json.dumps(value, separators=(",", ":"))), kind)


def _let(value: Column, body) -> Column:
    """`body(value)` with the value worked out once."""
    return F.element_at(F.transform(F.array(value), body), 1)


@lru_cache(4)
def _buckets(path: str) -> str:
    buckets: list[list[int]] = [[] for _ in range(BUCKETS)]
    for (a, b), c in vocabulary(path)[1].items():
        key = _KEYED + (a << 16 | b)
        buckets[key % BUCKETS] += [key, c]
    return json.dumps(buckets, separators=(",", ":"))


def _merged(ranks: Column, a: Column, b: Column) -> Column:
    """The id that a pair merges to, or NO_MERGE."""
    key = F.lit(_KEYED) + a.cast("long") * 65536 + b.cast("long")

    def found(k: Column) -> Column:
        bucket = F.element_at(ranks, (F.pmod(k, F.lit(BUCKETS)) + 1).cast("int"))
        return _let(bucket, lambda x: _let(F.array_position(x, k), lambda p: F.when(p > 0, F.element_at(x, (p + 1).cast("int"))).otherwise(F.lit(NO_MERGE).cast("long"))))

    return _let(key, found)


def encode_bytes(raw: Column, path: str = VOCABULARY) -> Column:
    """The ids of a word's bytes (array<bigint>) by a fold of ranked merges."""
    # Bound once: the plan holds the literal in one place only.
    ranks = F.from_json(F.lit(_buckets(path)), "array<array<bigint>>")
    letters = _literal(vocabulary(path)[0], "array<bigint>")
    return _let(F.struct(ranks.alias("r"), letters.alias("l")), lambda c: _fold(raw, c["r"], c["l"]))


def _fold(raw: Column, ranks: Column, letters: Column) -> Column:
    ids = F.transform(F.sequence(F.lit(1), F.length(raw)), lambda i: F.element_at(letters, F.ascii(F.substring(raw, i, F.lit(1))) + 1))
    pairs = lambda x: F.when(F.size(x) > 1, F.transform(F.sequence(F.lit(1), F.size(x) - 1), lambda i: _merged(ranks, F.element_at(x, i), F.element_at(x, i + 1)))).otherwise(F.array().cast("array<bigint>"))
    none = F.array().cast("array<bigint>")

    def step(acc: Column, _: Column) -> Column:
        ids, nxt = acc["ids"], acc["nxt"]

        def merge(m: Column) -> Column:
            def at(p: Column) -> Column:
                n = F.size(ids)
                before = F.when(p > 1, F.array(_merged(ranks, F.element_at(ids, p - 1), m))).otherwise(none)
                after = F.when(p + 1 < n, F.array(_merged(ranks, m, F.element_at(ids, p + 2)))).otherwise(none)
                return F.struct(
                    F.concat(F.slice(ids, F.lit(1), p - 1), F.array(m), F.slice(ids, p + 2, F.greatest(n - p - 1, F.lit(0)))).alias("ids"),
                    F.concat(F.slice(nxt, F.lit(1), F.greatest(p - 2, F.lit(0))), before, after, F.slice(nxt, p + 2, F.greatest(n - p - 2, F.lit(0)))).alias("nxt"),
                )

            return F.when(m < NO_MERGE, _let(F.array_position(nxt, m).cast("int"), at)).otherwise(acc)

        return F.when(F.size(nxt) > 0, _let(F.array_min(nxt), merge)).otherwise(acc)

    start = _let(ids, lambda x: F.struct(x.alias("ids"), pairs(x).alias("nxt")))
    return _let(start, lambda s: F.aggregate(F.sequence(F.lit(1), F.greatest(F.size(s["ids"]) - 1, F.lit(1))), s, step, lambda a: a["ids"]))


def merge_bytes(raw: bytes, path: str = VOCABULARY) -> list[int]:
    """The same merges by a heap over a linked list: for very long words."""
    letters, merges, _ = vocabulary(path)
    ids: list[int | None] = [letters[b] for b in raw]
    left, right = list(range(-1, len(ids) - 1)), list(range(1, len(ids) + 1))
    heap = [(c, i, ids[i], ids[i + 1]) for i in range(len(ids) - 1) if (c := merges.get((ids[i], ids[i + 1]))) is not None]
    heapq.heapify(heap)
    while heap:
        c, i, a, b = heapq.heappop(heap)
        j = right[i]
        if ids[i] != a or j >= len(ids) or ids[j] != b:
            continue
        ids[i], ids[j] = c, None
        right[i] = right[j]
        if right[i] < len(ids):
            left[right[i]] = i
        for x, y in ((left[i], i), (i, right[i])):
            if x >= 0 and y < len(ids) and (d := merges.get((ids[x], ids[y]))) is not None:
                heapq.heappush(heap, (d, x, ids[x], ids[y]))
    return [i for i in ids if i is not None]


def known_parts(df: DataFrame, text: str, path: str = VOCABULARY) -> DataFrame:
    """`b` (a distinct part's bytes as Latin-1 letters), `n` (how often it occurs), `i` (its ids)."""

    def distinct(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            texts = b["t"].tolist()
            for s in _batches(texts):
                raw, starts, _ = split_parts(texts[s], path)
                h, lengths = part_hashes(raw, starts)
                _, first, n = np.unique(h, return_index=True, return_counts=True)
                letters = raw.tobytes().decode("latin-1")
                yield pd.DataFrame({"b": [letters[x:y] for x, y in zip(starts[first].tolist(), (starts + lengths)[first].tolist())], "n": n})

    # Few bytes but much work: a stated number of tasks, which AQE doesn't coalesce.
    spark = df.sparkSession
    tasks = max(4 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    counts = df.select(F.col(text).alias("t")).mapInPandas(distinct, "b string, n long").groupBy("b").agg(F.sum("n").alias("n")).repartition(tasks)
    short = F.length("b") <= LONG_WORD

    @F.pandas_udf("array<bigint>")
    def by_heap(raw: pd.Series) -> pd.Series:
        return raw.map(lambda b: merge_bytes(b.encode("latin-1"), path))

    folded = counts.where(short).select("b", "n", encode_bytes(F.col("b"), path).cast("array<int>").alias("i"))
    return folded.unionByName(counts.where(~short).select("b", "n", by_heap("b").cast("array<int>").alias("i")))


def encode(df: DataFrame, key: str = "doc_id", text: str = "text", path: str = VOCABULARY, hot: int = HOT) -> DataFrame:
    """`key`, `ids` (array<int>), a row for each row."""
    from ..session import balanced, checkpointed

    spark = df.sparkSession
    docs = df.select(F.col(key).alias("k"), F.col(text).alias("t"), F.xxhash64(text).alias("h"))
    some = balanced(docs.where(F.length("t") > 0))
    known = checkpointed(known_parts(some, "t", path))
    rows = known.where(F.length("b") <= HOT_BYTES).orderBy(F.desc("n"), "b").limit(hot).select("b", "i").toPandas()
    frequent = spark.sparkContext.broadcast(_Hot([b.encode("latin-1") for b in rows["b"]], list(rows["i"])))

    def put(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """The ids of the frequent parts (two bytes each, as no vocabulary here has more than 2^16, compressed), and where between them which other parts belong."""
        table, pack = frequent.value, zstandard.ZstdCompressor(level=1).compress
        for b in batches:
            texts = b["t"].tolist()
            for s in _batches(texts):
                raw, starts, owner = split_parts(texts[s], path)
                h, lengths = part_hashes(raw, starts)
                found = table.find(raw, starts, h, lengths)
                n_ids = np.where(found >= 0, table.n_ids[found] if len(table.n_ids) else 0, 0)
                ids = table.ids[_expand(table.at[found[found >= 0]], n_ids[found >= 0])].astype("<u2")
                n_docs = s.stop - s.start
                count = np.bincount(owner, weights=n_ids, minlength=n_docs).astype(np.int64)
                begin = np.cumsum(count) - count
                other = np.flatnonzero(found < 0)
                place = (np.cumsum(n_ids) - n_ids)[other] - begin[owner[other]]
                letters = raw.tobytes().decode("latin-1")
                rest = [letters[x : x + y] for x, y in zip(starts[other].tolist(), lengths[other].tolist())]
                edge = np.searchsorted(owner[other], np.arange(n_docs + 1))
                coded = ids.tobytes()
                yield pd.DataFrame({
                    "k": b["k"].to_numpy()[s], "h": b["h"].to_numpy()[s], "ids": [pack(coded[2 * x : 2 * (x + y)]) for x, y in zip(begin.tolist(), count.tolist())],
                    "places": [place[x:y] for x, y in zip(edge[:-1], edge[1:])], "rest": [rest[x:y] for x, y in zip(edge[:-1], edge[1:])],
                })

    @F.pandas_udf("array<int>")
    def numbers(coded: pd.Series) -> pd.Series:
        unpack = zstandard.ZstdDecompressor().decompress
        return coded.map(lambda c: np.frombuffer(unpack(c), dtype="<u2").astype(np.int32))

    if len(vocabulary(path)[2]) > 1 << 16:
        raise ValueError("ids of more than two bytes")
    kind = docs.schema["k"].dataType.simpleString()
    coded = checkpointed(some.mapInPandas(put, f"k {kind}, h long, ids binary, places array<int>, rest array<string>"))
    whole = coded.where(F.size("rest") == 0).select("k", numbers("ids").alias("ids"))
    # The other parts, each once for a document and place, get their ids and come back in order.
    holes = coded.where(F.size("rest") > 0)
    each = holes.select("k", "h", F.posexplode("rest").alias("p", "b")).distinct().join(known.select("b", "i"), "b")
    filled = each.groupBy("k", "h").agg(F.array_sort(F.collect_list(F.struct("p", "i"))).alias("f")).select(F.col("k").alias("_k"), F.col("h").alias("_h"), "f")
    got = holes.select("k", "h", "places", numbers("ids").alias("own")).join(filled, F.col("k").eqNullSafe(F.col("_k")) & (F.col("h") == F.col("_h"))).select("k", "own", "places", "f")
    between = F.transform("f", lambda x, j: F.concat(F.slice("own", F.when(j == 0, 0).otherwise(F.get("places", j - 1)) + 1, F.get("places", j) - F.when(j == 0, 0).otherwise(F.get("places", j - 1))), x["i"]))
    tail = F.slice("own", F.get("places", F.size("places") - 1) + 1, F.size("own") - F.get("places", F.size("places") - 1))
    mended = got.select("k", F.concat(F.flatten(between), tail).alias("ids"))
    empty = docs.where("t is null or length(t) = 0").select("k", F.array().cast("array<int>").alias("ids"))
    return whole.unionByName(mended).unionByName(empty).withColumnRenamed("k", key)


def decode(df: DataFrame, ids: str = "ids", out: str = "decoded", path: str = VOCABULARY) -> DataFrame:
    """`df` with the text of its ids: the binary pieces, concatenated. NULL ids and ids outside the vocabulary give NULL."""
    pieces = _literal([p.hex() for p in vocabulary(path)[2]], "array<string>")
    text = F.decode(F.unhex(F.array_join(F.transform(F.col(ids), lambda i: F.try_element_at(pieces, i + 1)), "")), "UTF-8")
    return df.withColumn(out, F.when(F.forall(F.col(ids), lambda i: i.between(0, len(vocabulary(path)[2]) - 1)), text))
