"""Runs of repeated neighbouring events, collapsed into one event each.

Cues are range-partitioned by (track, position), so that a track of any length is spread over many tasks. Each task encodes the runs of
its stretch and keeps one summary: its first and last cue and the runs that touch its ends. Summaries combine associatively; a tree of
merges (`FAN_IN` stretches at a time) joins a last run and the next first run where the cue after the cut repeats the one before it.

Defined results: a cue is one (track, position), deliveries of it again count once (the earliest); a cue whose text is NULL, empty, blank
or has neither letter nor digit, and one without times, is in no run; ties and gaps in position end a run; only runs of two or more are rows.
"""

from __future__ import annotations

import html
import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_GAP_S = 2.0
MAX_EDITS = 2
FAN_IN = 64

_TAG = re.compile(r"</?[A-Za-z][^<>]*>|<\d[\d:.]*>|\{\\[^{}]*\}")
_OTHER = re.compile(r"[\W_]+")
_DIGITS = re.compile(r"\d+")


@lru_cache(20_000)
def plain(text: str | None) -> tuple[str, tuple[str, ...]]:
    """(letters and digits alone, folded; the numbers): what of a cue's text counts."""
    if not text:
        return "", ()
    t = _TAG.sub(" ", text)
    if "&" in t:
        t = _TAG.sub(" ", html.unescape(html.unescape(t)))
    t = unicodedata.normalize("NFKC", t).casefold()
    # Combining marks are kept; invisible characters go with the symbols.
    t = "".join(c for c in t if unicodedata.category(c) != "Cf") if not t.isascii() else t
    kept = "".join(c for c in t if c.isalnum() or unicodedata.category(c)[0] == "M") if not t.isascii() else _OTHER.sub("", t)
    return kept, tuple(_DIGITS.findall(t))


def within(a: str, b: str, most: int = MAX_EDITS) -> bool:
    """Whether `a` becomes `b` by at most `most` letters added, dropped, replaced or swapped with a neighbour."""
    if a == b:
        return True
    if abs(len(a) - len(b)) > most:
        return False
    i, n = 0, min(len(a), len(b))
    while i < n and a[i] == b[i]:
        i += 1
    j = 0
    while j < n - i and a[-1 - j] == b[-1 - j]:
        j += 1
    a, b = a[i : len(a) - j], b[i : len(b) - j]
    if max(len(a), len(b)) <= 1:
        return True
    big = most + 1
    before, row = {}, {y: y for y in range(min(len(b), most) + 1)}
    for x in range(1, len(a) + 1):
        new = {}
        for y in range(max(0, x - most), min(len(b), x + most) + 1):
            if y == 0:
                new[y] = x
                continue
            c = min(row.get(y - 1, big) + (a[x - 1] != b[y - 1]), row.get(y, big) + 1, new.get(y - 1, big) + 1)
            if x > 1 and y > 1 and a[x - 1] == b[y - 2] and a[x - 2] == b[y - 1]:
                c = min(c, before.get(y - 2, big) + 1)
            new[y] = c
        before, row = row, new
        if min(row.values()) > most and min(before.values()) > most:
            return False
    return row.get(len(b), big) <= most


# A cue is (track, pos, start, end, text); a run is (track, first_pos, last_pos, start, end, count, text).


def repeats(before: tuple, cue: tuple, max_gap: float = MAX_GAP_S, max_edits: int = MAX_EDITS) -> bool:
    """Whether a cue repeats the one before it."""
    if before[0] != cue[0] or cue[1] != before[1] + 1 or cue[2] is None or before[3] is None or not cue[2] - before[3] <= max_gap + 1e-9:
        return False
    a, b = plain(before[4]), plain(cue[4])
    return bool(a[0]) and bool(b[0]) and a[1] == b[1] and within(a[0], b[0], max_edits)


def _start(cue: tuple) -> tuple:
    return (cue[0], cue[1], cue[1], cue[2], cue[3], 1, cue[4])


def _join(a: tuple, b: tuple) -> tuple:
    return (a[0], a[1], b[2], min(a[3], b[3]), max(a[4], b[4]), a[5] + b[5], a[6])


def combine(a: tuple, b: tuple, same) -> tuple[tuple, list[tuple]]:
    """Two neighbouring summaries (first cue, last cue, first run, last run or None if one run is all) as one, and the runs that are now closed."""
    fc, _, fr, lr = a
    _, lc, fr2, lr2 = b
    if same(a[1], b[0]):
        joined = _join(lr or fr, fr2)
        if lr is None:
            return (fc, lc, joined, lr2), []
        return ((fc, lc, fr, joined), []) if lr2 is None else ((fc, lc, fr, lr2), [joined])
    closed = [lr] if lr is not None else []
    return (fc, lc, fr, lr2) if lr2 is not None else (fc, lc, fr, fr2), closed + ([fr2] if lr2 is not None else [])


def _fold(cues: Iterator[tuple], same) -> Iterator[tuple[str, tuple]]:
    """The closed runs of a stretch, then its summary."""
    summary = None
    for cue in cues:
        own = (cue, cue, _start(cue), None)
        if summary is None:
            summary = own
            continue
        summary, closed = combine(summary, own, same)
        for r in closed:
            yield "run", r
    if summary is not None:
        yield "summary", summary


_RUN_FIELDS = ("track_id", "first_pos", "last_pos", "start", "end", "count", "text")
_SCHEMA = "part long, kind string, " + ", ".join(
    f"{p}_track string, {p}_pos long, {p}_to long, {p}_start double, {p}_end double, {p}_n long, {p}_text string" for p in ("fr", "lr", "fc", "lc")
)
_COLUMNS = [c.split()[0] for c in _SCHEMA.split(", ")]
_NONE = (None,) * 7


def _row(part: int, kind: str, x: tuple) -> tuple:
    if kind == "run":
        return (part, kind, *x, *_NONE * 3)
    fc, lc, fr, lr = x
    wide = lambda c: (c[0], c[1], None, c[2], c[3], None, c[4])
    return (part, kind, *fr, *(lr or _NONE), *wide(fc), *wide(lc))


def _frame(rows: list[tuple]) -> pd.DataFrame:
    out = pd.DataFrame(rows, columns=_COLUMNS)
    for c in _COLUMNS:
        if c.endswith(("_pos", "_to", "_n")):
            out[c] = out[c].astype("Int64")
    return out


def _summary_of(r) -> tuple:
    run = lambda p: None if pd.isna(getattr(r, p + "_pos")) else (getattr(r, p + "_track"), int(getattr(r, p + "_pos")), int(getattr(r, p + "_to")), getattr(r, p + "_start"), getattr(r, p + "_end"), int(getattr(r, p + "_n")), getattr(r, p + "_text"))
    cue = lambda p: (getattr(r, p + "_track"), int(getattr(r, p + "_pos")), getattr(r, p + "_start"), getattr(r, p + "_end"), getattr(r, p + "_text"))
    return cue("fc"), cue("lc"), run("fr"), run("lr")


def collapse(df: DataFrame, track: str = "track_id", pos: str = "pos", start: str = "cue_start", end: str = "cue_end", text: str = "text", arrived: str = "ingested_at", max_gap: float = MAX_GAP_S, max_edits: int = MAX_EDITS, partitions: int | None = None) -> DataFrame:
    """Runs of two or more: `track_id`, `first_pos`, `last_pos`, `n_cues`, `run_start`, `run_end`, `duration`, `text` (the first cue's).

    One range shuffle of the cues; the tree of merges moves one row for each stretch.
    """
    from pyspark import TaskContext

    same = lambda a, b: repeats(a, b, max_gap, max_edits)
    kept = df.select(
        F.col(track).cast("string").alias("t"), F.col(pos).cast("long").alias("p"), F.col(start).cast("double").alias("s"), F.col(end).cast("double").alias("e"),
        F.col(text).alias("x"), F.col(arrived).alias("g"),
    ).where("t is not null and p is not null")
    ranged = kept.repartitionByRange(partitions, "t", "p") if partitions else kept.repartitionByRange("t", "p")
    ranged = ranged.sortWithinPartitions("t", "p", "g").select("t", "p", "s", "e", "x")

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part = TaskContext.get().partitionId()

        def cues() -> Iterator[tuple]:
            last = None
            for b in batches:
                for t, p, s, e, x in zip(b["t"].tolist(), b["p"].tolist(), b["s"].tolist(), b["e"].tolist(), b["x"].tolist()):
                    if (t, p) != last:
                        last = (t, p)
                        yield (t, p, s, e, x)

        rows = []
        for kind, x in _fold(cues(), same):
            if kind == "summary" or x[5] > 1:
                rows.append(_row(part, kind, x))
            if len(rows) >= 5000:
                yield _frame(rows)
                rows = []
        yield _frame(rows)

    def merge(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("part")
        rows, now = [], None
        for r in pdf.itertuples():
            if now is None:
                now = _summary_of(r)
                continue
            now, closed = combine(now, _summary_of(r), same)
            rows += [_row(0, "run", x) for x in closed if x[5] > 1]
        return _frame([*rows, _row(int(pdf["part"].iloc[0]) // FAN_IN, "summary", now)])

    from ..session import checkpointed

    encoded = checkpointed(ranged.mapInPandas(encode, _SCHEMA))
    done, open_ends = encoded.where("kind = 'run'"), encoded.where("kind = 'summary'")
    # Each level joins FAN_IN stretches, until one summary is left; it is one small row for each of them, written once and read twice.
    stretches = (encoded.agg(F.max("part")).first()[0] or 0) + 1
    while stretches > 1:
        merged = checkpointed(open_ends.groupBy(F.floor(F.col("part") / FAN_IN).alias("g")).applyInPandas(merge, _SCHEMA))
        done, open_ends = done.unionByName(merged.where("kind = 'run'")), merged.where("kind = 'summary'")
        stretches = -(-stretches // FAN_IN)
    run = lambda f, p: f.select(*[F.col(f"{p}_{a}").alias(b) for a, b in (("track", "track_id"), ("pos", "first_pos"), ("to", "last_pos"), ("n", "n_cues"), ("start", "run_start"), ("end", "run_end"), ("text", "text"))])
    ends = run(open_ends, "fr").unionByName(run(open_ends.where("lr_pos is not null"), "lr"))
    runs = run(done, "fr").unionByName(ends).where("n_cues > 1")
    return runs.withColumn("duration", F.col("run_end") - F.col("run_start"))
