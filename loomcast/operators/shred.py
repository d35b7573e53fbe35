"""Nested JSON to related flat tables by columnar shredding.

A record is first cut into columns: one per leaf path, each a sequence of (value, repetition level, definition level) as in the
Dremel encoding. The repetition level names the repeated ancestor at which an entry starts anew, the definition level counts how many
of the path's steps are present. Tables, one per repeated ancestor, are then put together again from the level sequences alone.

Defined results: NULL, blank, broken and non-object records give no rows; a null element takes its place but
is no row; an empty object is a row without columns; repeated keys keep the last value; nesting that the JSON reader refuses (some thousand
levels) is unreadable, any other depth is shredded; JSON kept as text is read however often it was kept so; values of any length are kept whole.
"""

from __future__ import annotations

import json
import sys
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Places at which a lone object stands for an array of one.
LONE_OBJECTS = ("common.people", "assets.transcripts", "assets.chapters", "assets.source_texts", "people")

#: Keys whose members may hold JSON kept as text.
TEXT_HOLDERS = ("source_data",)

#: Frames for the walks below, which need a few a level: above what the JSON reader's own limit lets in.
MOST_FRAMES = 100_000

_OBJECT = "{}"
#: No object without a brace, which JSON kept as text may write as an escape.
_HAS_OBJECT = "contains(t, '{') or contains(lower(t), 'u007b')"

NODE_SCHEMA = "node_path string, parent_path string, table_path string, position int, depth int, fields map<string,string>"
LEVEL_SCHEMA = "leaf_path string, rep array<int>, def array<int>, value array<string>"


def _refuse(name: str) -> None:
    raise ValueError(name)


def read_record(text: str | None, lone: tuple[str, ...] = LONE_OBJECTS, holders: tuple[str, ...] = TEXT_HOLDERS) -> dict | None:
    """The record as an object, JSON kept as text taken for what it holds; None if it is unreadable or no object."""

    def held(value):
        while isinstance(value, str):  # each reading takes the quotes away, so it ends
            value = json.loads(value, parse_constant=_refuse)
        return value

    try:
        value = held(text)
        if not isinstance(value, dict):
            return None
        for h in holders:
            if isinstance(value.get(h), str):
                try:
                    value[h] = held(value[h])
                except (ValueError, RecursionError):
                    pass
            if isinstance(value.get(h), dict):
                for k, v in value[h].items():
                    if isinstance(v, str) and v.lstrip()[:1] in ("{", "[", '"'):
                        try:
                            value[h][k] = held(v)
                        except (ValueError, RecursionError):
                            pass
        for path in lone:
            *up, last = path.split(".")
            at = value
            for k in up:
                at = at.get(k) if isinstance(at, dict) else None
            if isinstance(at, dict) and isinstance(at.get(last), dict):
                at[last] = [at[last]]
        return value
    except (ValueError, TypeError, RecursionError):
        return None


def shred(record: dict) -> dict[tuple[str, ...], list[tuple[int, int, str | None]]]:
    """Leaf path (steps; `[]` is a repeated step) -> entries (repetition level, definition level, value).

    Every leaf of a group gets an entry for each instance of the group, so that all columns under one repeated ancestor tell the same
    instances. An object's own presence is a leaf too (last step `{}`): it keeps empty objects apart from null ones.
    """
    columns: dict[tuple[str, ...], list] = {}
    sys.setrecursionlimit(max(sys.getrecursionlimit(), MOST_FRAMES))
    schema = _schema_of(record)

    def missing(node: dict, path: tuple, rep: int, defined: int) -> None:
        for step, below in node.items():
            if below is None:
                columns.setdefault((*path, step), []).append((rep, defined, None))
            else:
                missing(below, (*path, step), rep, defined)

    def walk(value, node: dict, path: tuple, rep: int, defined: int, level: int) -> None:
        for step, below in node.items():
            at = (*path, step)
            if step == "[]":
                if isinstance(value, list) and value:
                    for i, x in enumerate(value):
                        walk(x, below, at, rep if not i else level + 1, defined + 1, level + 1)
                else:
                    missing({step: below}, path, rep, defined)
            elif step == _OBJECT:
                columns.setdefault(at, []).append((rep, defined + isinstance(value, dict), None))
            elif step == "=":
                scalar = value is not None and not isinstance(value, (dict, list))
                columns.setdefault(at, []).append((rep, defined + scalar, _text(value) if scalar else None))
            elif isinstance(value, dict) and step[1:] in value:
                walk(value[step[1:]], below, at, rep, defined + 1, level)
            else:
                missing({step: below}, path, rep, defined)

    walk(record, schema, (), 0, 0, 0)
    return columns


def _clean(text: str) -> str:
    """Lone surrogates can't be stored as UTF-8: they become U+FFFD."""
    return text if text.isascii() else text.encode("utf-16", "surrogatepass").decode("utf-16", "replace")


def _text(value) -> str:
    return _clean(value) if isinstance(value, str) else json.dumps(value)


def _schema_of(value, node: dict | None = None) -> dict:
    """The union of the shapes found at each path: steps `.key`, `[]`, and the leaves `{}` (object) and `=` (scalar)."""
    node = {} if node is None else node
    if isinstance(value, dict):
        node.setdefault(_OBJECT, None)
        for k, v in value.items():
            _schema_of(v, node.setdefault("." + k, {}))
    elif isinstance(value, list):
        below = node.setdefault("[]", {})
        for x in value:
            _schema_of(x, below)
    else:
        node.setdefault("=", None)
    return node


def _name(steps: tuple[str, ...], index: list[int] | None = None) -> str:
    out, k = [], 0
    for s in steps:
        if s == "[]":
            out.append("[]" if index is None else f"[{index[k]}]")
            k += 1
        else:
            out.append(s)
    return _clean("".join(out).removeprefix("."))


def _positions(steps: tuple[str, ...], entries: list[tuple[int, int, str | None]]) -> Iterator[tuple[tuple[int, ...], int, str | None]]:
    """The index of each entry at the repeated steps of its path, from the repetition levels; with its definition level and value."""
    depth = steps.count("[]")
    index = [0] * depth
    for n, (rep, defined, value) in enumerate(entries):
        if n and rep:
            index[rep - 1] += 1
            index[rep:] = [0] * (depth - rep)
        elif n:
            index = [0] * depth
        yield tuple(index), defined, value


def rebuild(columns: dict[tuple[str, ...], list[tuple[int, int, str | None]]]) -> list[tuple]:
    """Rows (node_path, parent_path, table_path, position, depth, fields) of every object that is an element of an array."""
    nodes: dict[tuple, tuple] = {}
    fields: dict[tuple, dict[str, str]] = {}
    for steps, entries in columns.items():
        if "[]" not in steps:
            continue
        cut = len(steps) - steps[::-1].index("[]")
        above, own = steps[:cut], steps[cut:]
        for index, defined, value in _positions(steps, entries):
            if defined < len(steps):
                continue  # some step of the path is absent in this entry
            if own == (_OBJECT,):
                nodes[above, index] = ()
            elif own[-1] == "=" and own != ("=",):
                fields.setdefault((above, index), {})[_name(own[:-1])] = value
    out = []
    for above, index in nodes:
        parent, k = "", len(index) - 1
        for cut in range(len(above) - 1, 0, -1):
            if above[cut - 1] == "[]":
                if (above[:cut], index[:k]) in nodes:
                    parent = _name(above[:cut], index[:k])
                    break
                k -= 1
        out.append((_name(above, index), parent, _name(above), index[-1], len(index), fields.get((above, index), {})))
    return out


def nodes(df: DataFrame, key: str = "id", text: str = "metadata_json") -> DataFrame:
    """All child tables at once: `key`, `node_path`, `parent_path` ('' is the record), `table_path`, `position`, `depth`, `fields`.

    `where(table_path == ...)` is the flat table of one repeated ancestor; (`key`, `parent_path`) is the link to its parent.
    A record is shredded where it is read: no shuffle but the spreading of a small input over the cores.
    """
    from ..session import balanced

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for k, t in zip(b["k"], b["t"]):
                if (record := read_record(t)) is not None:
                    rows += [(k, *r) for r in rebuild(shred(record))]
            out = pd.DataFrame(rows, columns=["k", "node_path", "parent_path", "table_path", "position", "depth", "fields"])
            yield out.astype({"k": b["k"].dtype}) if len(out) else out

    kind = df.schema[key].dataType.simpleString()
    narrow = balanced(df.select(F.col(key).alias("k"), F.col(text).alias("t")).where(_HAS_OBJECT))
    return narrow.mapInPandas(run, f"k {kind}, {NODE_SCHEMA}").withColumnRenamed("k", key)


def levels(df: DataFrame, key: str = "id", text: str = "metadata_json") -> DataFrame:
    """The shredded columns themselves: `key`, `leaf_path`, `rep`, `def`, `value`, one row per record and leaf path."""
    from ..session import balanced

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for k, t in zip(b["k"], b["t"]):
                if (record := read_record(t)) is not None:
                    rows += [(k, _name(p), [e[0] for e in c], [e[1] for e in c], [e[2] for e in c]) for p, c in shred(record).items() if p[-1] == "="]
            yield pd.DataFrame([(k, p.removesuffix("="), r, d, v) for k, p, r, d, v in rows], columns=["k", "leaf_path", "rep", "def", "value"])

    kind = df.schema[key].dataType.simpleString()
    narrow = balanced(df.select(F.col(key).alias("k"), F.col(text).alias("t")).where(_HAS_OBJECT))
    return narrow.mapInPandas(run, f"k {kind}, {LEVEL_SCHEMA}").withColumnRenamed("k", key)


def child_table(all_nodes: DataFrame, table_path: str, columns: list[str], key: str = "id") -> DataFrame:
    """One flat table with named columns out of `nodes`; fields that a row lacks are NULL."""
    picked: list[Column] = [F.try_element_at("fields", F.lit(c)).alias(c.replace(".", "_")) for c in columns]
    return all_nodes.where(F.col("table_path") == table_path).select(key, "node_path", "parent_path", "position", *picked)
