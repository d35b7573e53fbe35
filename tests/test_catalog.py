"""Every query of the core runs, and agrees with its SQL on DuckDB."""

import datetime
import decimal
import math
import re
from collections import Counter
from pathlib import Path

import duckdb
import pytest

from loomcast.plans import catalog, lifecycle, problems


def plain(v):
    if isinstance(v, decimal.Decimal):
        v = float(v)
    if isinstance(v, float):
        return "nan" if math.isnan(v) else float(f"{v:.9g}")
    if isinstance(v, (list, tuple)):
        return tuple(map(plain, v))
    if isinstance(v, (datetime.date, datetime.datetime)):
        return str(v)
    return v


@pytest.fixture(scope="module")
def con(sf):
    c = duckdb.connect()
    for p in Path(sf).glob("*.parquet"):
        c.execute(f"create view {p.stem} as select * from '{p}'")
    return c


@pytest.mark.parametrize("name", sorted({**catalog.SQL, **lifecycle.SQL}))
def test_agrees_with_sql(spark, sf, con, name):
    df = {**catalog.QUERIES, **lifecycle.QUERIES, **problems.QUERIES}[name](spark, sf)
    result = con.execute({**catalog.SQL, **lifecycle.SQL, **problems.SQL}[name])
    names = [x[0] for x in result.description]
    assert sorted(names) == sorted(df.columns)
    want = Counter(tuple(plain(dict(zip(names, r))[c]) for c in sorted(names)) for r in result.fetchall())
    assert Counter(tuple(plain(r[c]) for c in sorted(names)) for r in df.collect()) == want


def test_estimated_clocks_agree_with_stated_ones(spark):
    """Over enough rows: with a handful of values a source's clock can't be told."""
    rows = problems.QUERIES["p1_agreement"](spark, "/root/testdata/sf0.01").collect()
    assert len(rows) == 12 and all(r.n_same == r.n_rows > 0 for r in rows)


OTHERS = {n: q for m in (catalog, lifecycle, problems) for n, q in m.QUERIES.items() if n not in m.SQL}


@pytest.mark.parametrize("name", sorted(OTHERS))
def test_has_rows(spark, sf, name):
    df = OTHERS[name](spark, sf)
    assert len(df.columns) > 1 and df.count() > 0


def test_values_against_plain_python(spark, sf, con):
    import email.utils
    import html as H
    import json
    import unicodedata

    def rows(sql):
        return con.execute(sql).fetchall()

    def same(name, want, *columns):
        got = Counter(tuple(r[c] for c in columns) for r in OTHERS[name](spark, sf).collect())
        assert got == Counter(want), name

    def iso(t):
        try:
            return email.utils.parsedate_to_datetime(t).isoformat()
        except (TypeError, ValueError, IndexError):
            return ""

    same("rfc2822_dates", [(i, iso(t)) for i, t in rows("select id, published_at from audio_urls")], "id", "iso")

    def caption(t):
        lines = [re.sub(r"[ \t\f\v]+", " ", H.unescape(re.sub("<[^>]+>", "", x))).strip() for x in (t or "").replace("\r", "").split("\n")]
        lines = [x for x in lines if x]
        return "\n".join(x for i, x in enumerate(lines) if not i or lines[i - 1] != x)

    cues = rows("select distinct track_id, pos, text from cues")
    same("caption_clean", [(t, p, caption(x)) for t, p, x in cues], "track_id", "pos", "clean")

    def recognised(t):
        kept = "".join(c for c in unicodedata.normalize("NFKC", t or "") if c.isspace() or not unicodedata.category(c).startswith("C"))
        return " ".join(kept.split())[:500]

    same("ocr_clean", [(t, p, recognised(x)) for t, p, x in cues], "track_id", "pos", "clean")
    for r in OTHERS["sidecar_documents"](spark, sf).collect():
        assert json.loads(r.document)["id"] == r.id
    for r in OTHERS["json_sanitize"](spark, sf).collect():
        assert (r.document is None) == bool(r.violations) and (r.document is None or "?" not in "".join(re.findall(r"https?://[^\s\"]*", r.document)))
    back = {(r.track_id, round(r.start, 3), round(r.end, 3)) for r in OTHERS["vtt_round_trip"](spark, sf).collect()}
    kept = {(t, round(max(s, 0), 3), round(e, 3)) for t, s, e, x in rows("select distinct track_id, cue_start, cue_end, text from cues") if x and caption(x) and round(e, 3) > round(max(s, 0), 3)}
    assert len(back ^ kept) <= 0.02 * len(kept)  # texts that hold line ends of their own part cues


def test_no_shortcuts_in_queries():
    text = Path(catalog.__file__).read_text()
    assert not re.search(r"\bsample\(|localCheckpoint|crossJoin", text)
